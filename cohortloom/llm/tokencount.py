"""Token counts by a tokenizer compiled to finite-state transducers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .bpe import NONE, BytePairs, portions, vocabulary

#: Characters of which one state map is made.
CHUNK = 512
#: States a worker's transducer may have before it starts anew, and bytes of a word that is long.
STATES = 110_000
LONG = 200

# Classes of characters: letters that contractions end with stand apart.
LETTER, STMD, R, V, L, E, NUMBER, OTHER, QUOTE, BLANK, SPACE, END = range(12)
# States of the word cutter, after a character.
(
    FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_BLANK, ONE_SPACE, MORE_BLANK, MORE_SPACE,
    AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L,
) = range(12)
NOW, LATE = 1, 2


def word_cutter() -> tuple[np.ndarray, np.ndarray]:
    """next[state, class] and marks[state, class] of the transducer that cuts texts into words.

    A mark NOW opens a word at the character read, LATE one at the character before it: whether the
    last blank of several belongs to the next word, or whether 'r opens a contraction, shows only
    then. After END the cutter is fresh.
    """
    letters = (LETTER, STMD, R, V, L, E)
    opens = dict.fromkeys(letters, IN_LETTERS) | {
        NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: AFTER_QUOTE, BLANK: ONE_BLANK, SPACE: ONE_SPACE,
    }
    joined = opens | {QUOTE: IN_OTHERS}
    spaces = {BLANK: MORE_BLANK, SPACE: MORE_SPACE}
    after = np.zeros((12, 12), np.uint8)
    marks = np.zeros((12, 12), np.uint8)

    def rule(state: int, kind: int, to: int, mark: int = 0) -> None:
        after[state, kind], marks[state, kind] = to, mark

    for kind, to in opens.items():
        for state in range(12):
            rule(state, kind, to, NOW)
        for state in (QUOTE_R, QUOTE_V, QUOTE_L):
            rule(state, kind, to, LATE if kind in letters else LATE | NOW)
        if kind in spaces:
            for state in (ONE_BLANK, ONE_SPACE, MORE_BLANK, MORE_SPACE):
                rule(state, kind, spaces[kind])
        else:
            rule(ONE_BLANK, kind, joined[kind])
            rule(MORE_BLANK, kind, joined[kind], LATE)
            rule(MORE_SPACE, kind, to, LATE | NOW)
    for kind in letters:
        rule(IN_LETTERS, kind, IN_LETTERS)
    rule(IN_NUMBERS, NUMBER, IN_NUMBERS)
    for state in (IN_OTHERS, AFTER_QUOTE):
        for kind in (OTHER, QUOTE):
            rule(state, kind, IN_OTHERS)
    rule(AFTER_QUOTE, STMD, FRESH)
    for kind, state, last in ((R, QUOTE_R, E), (V, QUOTE_V, E), (L, QUOTE_L, L)):
        rule(AFTER_QUOTE, kind, state)
        rule(state, last, FRESH)
    for state in range(12):
        rule(state, END, FRESH, LATE if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0)
    return after, marks


def character_classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\p{White_Space}", SPACE)):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    for c, kind in {"r": R, "v": V, "l": L, "e": E, "'": QUOTE, " ": BLANK}.items():
        out[ord(c)] = kind
    out[[ord(c) for c in "stmd"]] = STMD
    return out


def scanned(maps: np.ndarray) -> np.ndarray:
    """For each chunk the map of all chunks before it, by composing maps in doubling steps."""
    identity = np.arange(maps.shape[1], dtype=maps.dtype)[None]
    before = np.concatenate([identity, maps[:-1]])
    step = 1
    while step < len(before):
        later = np.take_along_axis(before[step:], before[:-step], axis=1)
        before = np.concatenate([before[:step], later])
        step *= 2
    return before


def run_cutter(classes: np.ndarray, after: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The marks at all characters, chunks side by side.

    First every chunk's map from state to state; a prefix scan of the maps gives the state that
    each chunk begins in; then all chunks run at once from there.
    """
    n_chunks = -(-len(classes) // CHUNK)
    grid = np.full(n_chunks * CHUNK, END, np.uint8)
    grid[: len(classes)] = classes
    grid = np.ascontiguousarray(grid.reshape(n_chunks, CHUNK).T)
    maps = np.broadcast_to(np.arange(12, dtype=np.uint8), (n_chunks, 12))
    for column in grid:
        maps = after[maps, column[:, None]]
    state = scanned(maps)[:, FRESH]
    out = np.empty_like(grid)
    for k, column in enumerate(grid):
        out[k] = marks[state, column]
        state = after[state, column]
    return out.T.reshape(-1)[: len(classes)]


class TokenCounter:
    """Counts the tokens of a byte-pair vocabulary without building them.

    Words go through a transducer over bytes. A step emits by how much the count of tokens of the
    prefix changes, so a word's count is the sum. The tokens of a prefix end with a token that began
    at some earlier place; a state holds what decides how it goes on: for every place where a token
    still going on may begin, the node of the vocabulary's prefix tree it has come to, the token
    before it, and the count there against the count now. States and steps are made when first
    needed.
    """

    def __init__(self, content: str):
        pairs = BytePairs(content)
        self.special = list(pairs.special)
        spelled = [
            pairs.bytes[a : a + n].tobytes() for a, n in zip(pairs.start, pairs.size, strict=True)
        ]
        left, right = pairs.keys >> 32, pairs.keys & 0xFFFFFFFF
        ids = np.unique(np.concatenate([left, right, pairs.joined, pairs.first])).tolist()
        # A token counts where it is what its own bytes are encoded as.
        whole = pairs.merge([spelled[i] for i in ids])[1] == 1
        self.rank = dict(zip(pairs.keys.tolist(), pairs.ranks.tolist(), strict=True))
        self.parents: dict[int, tuple[int, int, int]] = {}
        merges = zip(left.tolist(), right.tolist(), pairs.ranks.tolist(), pairs.joined.tolist())
        for a, b, rank, joined in sorted(merges, key=lambda x: -x[2]):
            self.parents[joined] = (a, b, rank)
        self.tree: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for i, good in zip(ids, whole.tolist(), strict=True):
            node = 0
            for b in spelled[i] if good else b"":
                if b not in self.tree[node]:
                    self.tree[node][b] = len(self.tree)
                    self.tree.append({})
                    self.token.append(-1)
                node = self.tree[node][b]
            if good:
                self.token[node] = i
        self.after, self.marks = word_cutter()
        self.classes = character_classes()
        self.spines: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self.forget()

    def forget(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.fits: dict[tuple[int, int], bool] = {}
        self.step = np.full((1024, 256), -1, np.int32)
        self.emit = np.zeros((1024, 256), np.int8)
        self.state_of(((0, -1, 0),))

    def state_of(self, places: tuple) -> int:
        if places not in self.number:
            self.number[places] = len(self.states)
            self.states.append(places)
            if len(self.states) > len(self.step):
                grow = len(self.step)
                self.step = np.concatenate([self.step, np.full((grow, 256), -1, np.int32)])
                self.emit = np.concatenate([self.emit, np.zeros((grow, 256), np.int8)])
        return self.number[places]

    def spine(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The token and its parts along one edge, with the rank at which each is used up."""
        key = (token, right)
        if key not in self.spines:
            out, until, at = [], NONE, token
            while True:
                out.append((at, until))
                if at not in self.parents:
                    break
                a, b, until = self.parents[at]
                at = b if right else a
            self.spines[key] = out
        return self.spines[key]

    def fit(self, a: int, b: int) -> bool:
        """Whether the two tokens stay apart: no pair across their border is joined in time."""
        key = (a, b)
        if key not in self.fits:
            self.fits[key] = not any(
                (rank := self.rank.get(x << 32 | y, NONE)) < until_x and rank <= until_y and rank < NONE
                for x, until_x in self.spine(a, True)
                for y, until_y in self.spine(b, False)
            )
        return self.fits[key]

    def make(self, state: int, byte: int) -> None:
        going, found = [], None
        for node, before, ahead in self.states[state]:
            node = self.tree[node].get(byte, -1)
            if node < 0:
                continue
            token = self.token[node]
            if found is None and token >= 0 and (before < 0 or self.fit(before, token)):
                found = (token, ahead + 1)
            if self.tree[node]:
                going.append((node, before, ahead))
        token, change = found
        places = tuple((n, t, c - change) for n, t, c in going) + ((0, token, 0),)
        to = self.state_of(places)
        self.step[state, byte], self.emit[state, byte] = to, change

    def count_words(self, content: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of each word content[start : start + size], all words side by side."""
        if len(self.states) > STATES:
            self.forget()
        order = np.argsort(-size, kind="stable")
        start, ordered = start[order], size[order]
        tokens = np.zeros(len(size), np.int64)
        n_long = int(np.searchsorted(-ordered, -LONG, "left"))
        for w in range(n_long):
            tokens[w] = self.count_long(content[start[w] : start[w] + ordered[w]].tobytes())
        start, ordered, counted = start[n_long:], ordered[n_long:], tokens[n_long:]
        state = np.zeros(len(start), np.int32)
        falling = -ordered
        for k in range(int(ordered[0]) if len(ordered) else 0):
            m = int(np.searchsorted(falling, -k, "left"))
            byte = content[start[:m] + k]
            to = self.step[state[:m], byte]
            if (to < 0).any():
                missing = np.unique(state[:m][to < 0].astype(np.int64) << 8 | byte[to < 0])
                for key in missing.tolist():
                    self.make(key >> 8, key & 255)
                to = self.step[state[:m], byte]
            counted[:m] += self.emit[state[:m], byte]
            state[:m] = to
        out = np.empty_like(tokens)
        out[order] = tokens
        return out

    def count_long(self, word: bytes) -> int:
        state = tokens = 0
        for byte in word:
            if self.step[state, byte] < 0:
                self.make(state, byte)
            tokens += int(self.emit[state, byte])
            state = int(self.step[state, byte])
            if len(self.states) > STATES:
                places = self.states[state]
                self.forget()
                state = self.state_of(places)
        return tokens

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a special token's string in it is one token."""
        parts: list[str] = []
        owner: list[int] = []
        extra = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = [text]
            if any(s in text for s in self.special):
                cut = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                pieces = regex.split(cut, text)
                extra[i] = len(pieces) - 1
            parts += pieces
            owner += [i] * len(pieces)
        points = np.frombuffer("\0".join([*parts, ""]).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        classes = self.classes[points]
        classes[ends] = END
        marks = run_cutter(classes, self.after, self.marks)
        opens = (marks & NOW) > 0
        opens[:-1] |= (marks[1:] & LATE) > 0
        opens[ends] = False
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        at_byte = np.cumsum(width) - width
        content = np.frombuffer("\0".join([*parts, ""]).encode(), np.uint8)
        first = np.flatnonzero(opens)
        part = np.searchsorted(ends, first)
        start = at_byte[first]
        following = np.concatenate([start[1:], [len(content)]])
        stop = np.minimum(following, at_byte[ends[part]])
        tokens = self.count_words(content, start, stop - start)
        of = np.array(owner, np.int64)[part]
        return extra + np.bincount(of, weights=tokens, minlength=len(texts)).astype(np.int64)


_counters: dict[int, TokenCounter] = {}


def counter(content: str) -> TokenCounter:
    key = hash(content)
    if key not in _counters:
        _counters[key] = TokenCounter(content)
    return _counters[key]


def counted(docs: DataFrame, path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """Adds the number of tokens of each text under the byte-level vocabulary in `path`.

    Nothing is added around a text; the string of a special token in it is one token. A missing or
    empty text has none. The other columns stay; a column named `n_tokens` is replaced. Repeated
    rows and the empty table need nothing special.
    """
    held = vocabulary(docs.sparkSession, path)

    @F.arrow_udf(LongType())
    def count(column: pa.Array) -> pa.Array:
        own = counter(held.value)
        texts = ["" if t is None else t for t in column.to_pylist()]
        parts = [own.count(run) for run in portions(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return docs.withColumn(n_tokens, count.asNondeterministic()(F.col(text)))


def utf8_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
