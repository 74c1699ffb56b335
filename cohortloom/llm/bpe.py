"""Byte-pair encoding and decoding in batched numpy merge rounds."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from .common import ship

#: Fixed value: how the byte-level vocabulary cuts texts into words.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Bytes of words that a worker remembers about, and characters it works on at once.
CACHED = 64 << 20
CHARACTERS = 1 << 19
#: Words of more bytes are joined by a queue of places, and not remembered.
LONG = 256
NONE = np.iinfo(np.int64).max


def printable() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes in turn for those from 256.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """A byte-level vocabulary as arrays: pairs by sorted key, and the bytes of every token."""

    def __init__(self, content: str):
        model = json.loads(content)
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        byte_of = printable()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        joined = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        # Of a pair named twice the first rank holds.
        self.keys, self.ranks = np.unique(keys, return_index=True)
        self.joined = joined[self.ranks]
        self.first = np.zeros(256, np.int64)
        for c, b in byte_of.items():
            self.first[b] = vocab[c]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        spelled = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        spelled |= {i: t.encode() for t, i in self.special.items()}
        parts = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.size = np.array([len(p) for p in parts], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in one array, and how many each word has."""
        lengths = np.array([len(w) for w in words], np.int64)
        long = lengths > LONG
        if not long.any():
            return self.rounds(words, lengths)
        results = (self.rounds, ~long), (self.queue, long)
        ids, sizes = [], np.zeros(len(words), np.int64)
        for way, which in results:
            at = np.flatnonzero(which)
            found, sizes[at] = way([words[i] for i in at], lengths[at])
            ids.append(found)
        ends = np.cumsum(sizes)
        out = np.zeros(int(ends[-1]), np.int64)
        for (_, which), found in zip(results, ids):
            out[spread((ends - sizes)[which], sizes[which])] = found
        return out, sizes

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair of symbols, NONE for unknown ones, and what known ones become."""
        key = left << 32 | right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.ranks[place], NONE), self.joined[place]

    def queue(self, words: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`merge` for long words: only places around a join are looked up again.

        Places wait in a queue by the rank of their pair; the lowest rank is joined wherever it
        stands, in all words. Symbols are linked to their neighbours, so that a place costs the
        same in a word of any length. Pairs with a joined symbol have higher ranks than its own.
        """
        total = int(lengths.sum())
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(lengths)
        following = np.arange(1, total + 1)
        following[ends - 1] = total
        preceding = np.arange(-1, total - 1)
        preceding[ends[:-1]] = -1
        # One place more, for what follows the last symbol of a word.
        preceding = np.append(preceding, -1)
        rank = np.full(total, NONE)
        becomes = np.zeros(total, np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def look(at: np.ndarray) -> None:
            at = at[following[at] < total]
            rank[at], becomes[at] = self.ranked(symbols[at], symbols[following[at]])
            at = at[rank[at] < NONE]
            at = at[np.argsort(rank[at], kind="stable")]
            cuts = np.flatnonzero(np.diff(rank[at])) + 1
            for part in np.split(at, cuts) if len(at) else ():
                own = int(rank[part[0]])
                if own not in waiting:
                    waiting[own] = []
                    heapq.heappush(order, own)
                waiting[own].append(part)

        look(np.arange(total))
        while order:
            lowest = heapq.heappop(order)
            at = np.unique(np.concatenate(waiting.pop(lowest)))
            at = at[rank[at] == lowest]
            if not len(at):
                continue
            # Of overlapping places every second counts, from the left.
            index = np.arange(len(at))
            opens = np.append(True, following[at[:-1]] != at[1:])
            at = at[(index - np.maximum.accumulate(np.where(opens, index, 0))) % 2 == 0]
            gone = following[at]
            symbols[at] = becomes[at]
            following[at] = following[gone]
            preceding[following[at]] = at
            rank[at] = rank[gone] = NONE
            symbols[gone] = -1
            before = preceding[at]
            before = before[before >= 0]
            rank[before] = NONE
            look(np.union1d(at, before))
        stays = symbols >= 0
        word = np.repeat(np.arange(len(words)), lengths)
        return symbols[stays], np.bincount(word[stays], minlength=len(words))

    def rounds(self, words: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`merge` in rounds.

        Every round looks all neighbouring pairs up at once and joins, in each word, its pair of
        the lowest rank wherever it stands. Words without a known pair leave the rounds.
        """
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            rank = np.full(len(symbols), NONE)
            at = np.flatnonzero(word[1:] == word[:-1])
            rank[at], becomes = self.ranked(symbols[at], symbols[at + 1])
            begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.concatenate([begins, [len(word)]]))
            best = np.repeat(best, sizes)
            ended = best == NONE
            if ended.any():
                done_symbols.append(symbols[ended])
                done_words.append(word[ended])
            chosen = (rank == best) & ~ended
            # Of overlapping places of one pair every second counts, from the left.
            index = np.arange(len(chosen))
            opens = chosen & ~np.concatenate([[False], chosen[:-1]])
            run = np.maximum.accumulate(np.where(opens, index, 0))
            chosen &= (index - run) % 2 == 0
            joins = np.flatnonzero(chosen)
            target = np.zeros(len(symbols), np.int64)
            target[at] = becomes
            symbols[joins] = target[joins]
            stays = ~ended
            stays[joins + 1] = False
            symbols, word = symbols[stays], word[stays]
        if not done_words:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        word = np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(word, minlength=len(words))

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens in one array, and how many each token has."""
        size = self.size[ids]
        return self.bytes[spread(self.start[ids], size)], size


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - (ends - size), size) + np.arange(total)


class Known:
    """Token ids of words by number, in arrays that grow by doubling; knows how much it holds."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(1 << 12, np.int32)
        self.start = np.zeros(1 << 10, np.int64)
        self.size = np.zeros(1 << 10, np.int64)
        self.meetings = np.zeros(1 << 10, np.int32)
        self.n_ids = self.held = 0

    def add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.number)
        self.ids = self.room(self.ids, self.n_ids + len(ids))
        self.start = self.room(self.start, n + len(words))
        self.size = self.room(self.size, n + len(words))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.start[n : n + len(words)] = self.n_ids + np.cumsum(sizes) - sizes
        self.size[n : n + len(words)] = sizes
        self.number.update(zip(words, range(n, n + len(words))))
        self.n_ids += len(ids)
        # A string, its entry and its numbers take about so much.
        self.held += 4 * len(ids) + sum(map(len, words)) + 200 * len(words)

    def forget(self, words: list[str], ids: int) -> None:
        """Takes the words added last, which have so many ids, back."""
        for word in words:
            del self.number[word]
        self.n_ids -= ids
        self.held -= 4 * ids + sum(map(len, words)) + 200 * len(words)

    def met(self, place: np.ndarray) -> None:
        """Notes that the words with these different numbers were used once more."""
        self.meetings = self.room(self.meetings, len(self.number))
        self.meetings[place] += 1

    def often(self) -> Known:
        """The words that were used several times, as long as they are the smaller part."""
        self.met(np.zeros(0, np.int64))
        again = np.flatnonzero(self.meetings[: len(self.number)] > 1)
        out = Known()
        if 2 * len(again) < len(self.number):
            names = list(self.number)
            out.add([names[i] for i in again.tolist()], *self.take(again))
            # They stay again if they are used again.
            out.met(np.arange(len(again)))
        return out

    @staticmethod
    def room(array: np.ndarray, n: int) -> np.ndarray:
        if n <= len(array):
            return array
        wider = np.zeros(max(n, 2 * len(array)), array.dtype)
        wider[: len(array)] = array
        return wider

    def take(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words with these numbers in one array, and how many each has."""
        size = self.size[place]
        return self.ids[spread(self.start[place], size)], size


class Encoder:
    """Encodes texts, remembering the tokens of words up to CACHED bytes; then it begins anew."""

    def __init__(self, pairs: BytePairs):
        self.pairs = pairs
        self.words = regex.compile(PATTERN)
        self.cut = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(pairs.special, key=len, reverse=True))) + ")"
        ) if pairs.special else None
        self.forget()

    def forget(self) -> None:
        self.known = Known()
        special = self.pairs.special
        self.known.add(list(special), np.array(list(special.values()), np.int64), np.ones(len(special), np.int64))

    def split(self, text: str) -> list[str]:
        """The words; a special token's string is a word of its own."""
        if self.cut is None or not any(s in text for s in self.pairs.special):
            return self.words.findall(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [part] if part in self.pairs.special else self.words.findall(part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        if self.known.held > CACHED:
            self.forget()
        known = self.known
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            new = self.split(text)
            counts[i] = len(new)
            words += new
        unseen = list(dict.fromkeys(w for w in words if w not in known.number))
        long = [w for w in unseen if len(w) > LONG]
        for added in ([w for w in unseen if len(w) <= LONG], long):
            if added:
                ids, sizes = self.pairs.merge([w.encode() for w in added])
                known.add(added, ids, sizes)
        place = np.fromiter(map(known.number.__getitem__, words), np.int64, len(words))
        ids, size = known.take(place)
        if long:
            # Long words are not kept.
            known.forget(long, int(sizes.sum()))
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts)]
        return ids, np.diff(np.concatenate([[0], ends]))


def portions(texts: list[str], characters: int = CHARACTERS) -> Iterator[list[str]]:
    """The texts in runs of about so many characters, a longer text alone."""
    run: list[str] = []
    held = 0
    for text in texts:
        if run and held + len(text) > characters:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


_encoders: dict[int, Encoder] = {}


def encoder(content: str) -> Encoder:
    """This worker's encoder for the vocabulary."""
    key = hash(content)
    if key not in _encoders:
        _encoders[key] = Encoder(BytePairs(content))
    return _encoders[key]


def strings(column: pa.Array, rows: int = 512) -> Iterator[list[str]]:
    """The texts in portions, a missing one as empty; few of them are Python objects at once."""
    for begin in range(0, len(column), rows):
        part = column.slice(begin, rows).to_pylist()
        yield from portions(["" if t is None else t for t in part])


def _lists(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int32)
    sizes = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))


def vocabulary(spark: SparkSession, path: str):
    """The vocabulary file, of a fixed size, broadcast to the workers."""
    ship(spark)
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of each text as an array of integers.

    Ids are those of the byte-level vocabulary in the file `path`, without added tokens; the string
    of a special token in a text becomes that token. A missing text counts as empty, an empty text
    has no ids. The other columns stay as they are; a column named `ids` is replaced. Repeated rows
    and the empty table need nothing special.
    """
    held = vocabulary(docs.sparkSession, path)

    @F.arrow_udf(ArrayType(IntegerType(), False))
    def encode(column: pa.Array) -> pa.Array:
        own = encoder(held.value)
        return _lists([own.encode(run) for run in strings(column)])

    # Not merged into what reads the ids: each reader would encode anew.
    return docs.withColumn(ids, encode.asNondeterministic()(F.col(text)))


def decoded(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for; a missing array counts as empty."""
    held = vocabulary(docs.sparkSession, path)

    @F.arrow_udf(StringType())
    def decode(column: pa.Array) -> pa.Array:
        pairs = encoder(held.value).pairs
        out = []
        for begin in range(0, len(column), 256):
            part = column.slice(begin, 256)
            flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            spelled, lengths = pairs.spell(flat)
            ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(sizes)].tolist()
            content, start = spelled.tobytes(), 0
            for end in ends:
                out.append(content[start:end].decode("utf-8", "replace"))
                start = end
        return pa.array(out, pa.string())

    return docs.withColumn(text, decode(F.col(ids)))


def round_trip(docs: DataFrame, path: str, text: str = "text", into: str = "coded") -> DataFrame:
    """Adds a struct of n_tokens, ids_sha256 and decoded_sha256: each text encoded and decoded.

    One pass does both, so that neither ids nor decoded texts leave the worker. ids_sha256 is the
    digest of the ids as little-endian unsigned 32-bit integers, decoded_sha256 that of the decoded
    text in UTF-8, both lowercase hex. Missing, empty and repeated texts as in `encoded`.
    """
    held = vocabulary(docs.sparkSession, path)

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def code(column: pa.Array) -> pa.Array:
        own = encoder(held.value)
        counts, ids_digests, text_digests = [], [], []
        for run in strings(column):
            ids, sizes = own.encode(run)
            spelled, lengths = own.pairs.spell(ids)
            content, flat = spelled.tobytes(), ids.astype("<u4")
            ends = np.cumsum(sizes)
            stops = np.concatenate([[0], np.cumsum(lengths)])[ends].tolist()
            start = begin = 0
            for end, stop in zip(ends.tolist(), stops):
                ids_digests.append(hashlib.sha256(flat[start:end]).hexdigest())
                decoded = content[begin:stop].decode("utf-8", "replace")
                text_digests.append(hashlib.sha256(decoded.encode()).hexdigest())
                start, begin = end, stop
            counts.append(sizes)
        return pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string()),
            ],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    # Not merged into what reads its fields: each reader would encode anew.
    return docs.withColumn(into, code.asNondeterministic()(F.col(text)))


def ids_sha256(ids: str = "ids") -> Column:
    """Digest of the ids as little-endian unsigned 32-bit integers, lowercase hex."""
    @F.arrow_udf(StringType())
    def digest(column: pa.Array) -> pa.Array:
        flat = column.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
        out, start = [], 0
        for end in ends:
            out.append(hashlib.sha256(flat[start:end].tobytes()).hexdigest())
            start = end
        return pa.array(out, pa.string())

    return digest(F.col(ids))
