"""Spelling variants: words one edit apart, by a bit-sliced index of letters at positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, ship

RUN = "[A-Za-zÀ-ÿ]+"
#: Words of at least so many code points and occurrences are looked at.
LETTERS, OCCURRENCES = 6, 5
#: A variant's form has at least so many times its occurrences.
RATIO = 5
#: Words are cut into so many pieces; two words one edit apart agree outside one of them.
PIECES = 3
#: Groups of more words than this are cut by single letters instead of pieces.
CROWD = 4096
#: Words and letters in one index, a group that needs more has one of its own.
WORDS, HELD = 4096, 1 << 18


def runs(text: str = "text", letters: int = LETTERS) -> Column:
    """The maximal runs of letters of a length from which a word may come, A-Z lower-cased."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # A run is matched whole, so a longer minimum does not cut it.
    found = F.regexp_extract_all(F.col(text), F.lit(RUN[:-1] + f"{{{letters},}}"), F.lit(0))
    return F.transform(
        found, lambda r: F.when(r.rlike("[A-Z]"), F.translate(r, upper, lower)).otherwise(r)
    )


def misspelled(run: Column, doc_id: Column, every: int = 199) -> Column:
    """The run without one letter where the hash of document and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(
        h % every == 0,
        F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run))),
    ).otherwise(run)


def vocabulary(
    words: DataFrame, word: str = "word", letters: int = LETTERS, occurrences: int = OCCURRENCES
) -> DataFrame:
    """(word, n) of the words long and frequent enough; counts are combined before the shuffle."""
    return (
        words.select(F.col(word).alias("word"))
        .filter(F.length("word") >= letters)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= occurrences)
    )


def grouped(words: DataFrame, pieces: int = PIECES, crowd: int = CROWD) -> DataFrame:
    """(key, word, n): words one edit apart share a key at least.

    A key is made for the length of the longer word, hence two lengths for each word: what stands
    before a piece, counted from the start, and after it, counted from the end. Members of a group
    of more than `crowd` words get a key for each letter of the piece instead, which only words that
    differ in this one letter share; so no group is larger than that or the alphabet.
    """
    length = F.length("word")
    cut = (
        words.withColumn("size", F.explode(F.array(length, length + 1)))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
        .withColumn("begin", F.expr(f"cast(piece * size div {pieces} as int)"))
        .withColumn("end", F.expr(f"cast((piece + 1) * size div {pieces} as int)"))
    )

    def key(begin: str, end: str) -> Column:
        rest = F.col("size") - F.col(end)
        tail = F.when(rest > 0, F.substring(F.col("word"), -rest, rest)).otherwise("")
        return F.xxhash64(
            "size", begin, end, F.substring(F.col("word"), F.lit(1), F.col(begin)), tail
        )

    cut = cut.withColumn("key", key("begin", "end"))
    members = cut.groupBy("key").agg(F.count("*").alias("members"))
    crowded = durable(members.filter(F.col("members") > crowd).select("key"))
    if crowded.isEmpty():
        return cut.select("key", "word", "n")
    usual = cut.join(crowded, "key", "left_anti").select("key", "word", "n")
    letters = (
        cut.join(crowded, "key", "left_semi")
        .filter(F.col("begin") < F.col("end"))
        .withColumn("begin", F.explode(F.expr("sequence(begin, end - 1)")))
        .withColumn("end", F.col("begin") + 1)
        .select(key("begin", "end").alias("key"), "word", "n")
    )
    return usual.unionByName(letters)


class LetterIndex:
    """For each position and letter the set of words that have it there, as bits of an array."""

    def __init__(self, words: list[str]):
        self.words = words
        self.width = -(-len(words) // 64)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum(self.lengths)
        owner = np.repeat(np.arange(len(words)), self.lengths)
        place = np.arange(len(points)) - np.repeat(ends - self.lengths, self.lengths)
        self.longest = int(self.lengths.max())
        self.points, self.starts = points, ends - self.lengths
        # Row 0 of the bits stays empty: no word has an unknown letter at a position.
        self.slots, row = np.unique(place << 32 | points, return_inverse=True)
        self.bits = np.zeros((len(self.slots) + 1, self.width), np.uint64)
        bit = np.uint64(1) << (owner % 64).astype(np.uint64)
        np.bitwise_or.at(self.bits, (row + 1, owner // 64), bit)

    def at(self, place: int, letters: np.ndarray) -> np.ndarray:
        """Words with each of the letters at the place, one row of bits per letter."""
        if place < 0 or place >= self.longest:
            return np.zeros((len(letters), self.width), np.uint64)
        key = place << 32 | letters
        found = np.minimum(np.searchsorted(self.slots, key), len(self.slots) - 1)
        return self.bits[np.where(self.slots[found] == key, found + 1, 0)]

    def of_length(self, length: int) -> np.ndarray:
        mark = np.zeros(self.width * 64, np.uint8)
        mark[: len(self.words)] = self.lengths == length
        return np.packbits(mark, bitorder="little").view(np.uint64)

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words one edit apart, for numbers of words that are of one length.

        After each letter of the queries, four sets of bits per query: words equal so far, words with
        one letter replaced, words without one letter of the query, which are one position behind,
        and words with one letter more, one position ahead.
        """
        length = int(self.lengths[queries[0]])
        letters = self.points[self.starts[queries][:, None] + np.arange(length)]
        shape = (len(queries), self.width)
        same = np.full(shape, ~np.uint64(0))
        other = np.zeros(shape, np.uint64)
        less = np.zeros(shape, np.uint64)
        more = np.full(shape, ~np.uint64(0))
        behind = np.zeros(shape, np.uint64)
        here = self.at(0, letters[:, 0])
        for i in range(length):
            c = letters[:, i]
            ahead = self.at(i + 1, c)
            if i:
                behind = self.at(i - 1, c)
            other = (other & here) | (same & ~here)
            less = (less & behind) | same
            same &= here
            more = (more & ahead) | same
            if i + 1 < length:
                here = self.at(i + 1, letters[:, i + 1])
        hits = (
            (other & self.of_length(length))
            | (less & self.of_length(length - 1))
            | (more & self.of_length(length + 1))
        )
        query, word = np.nonzero(hits)
        rows = hits[query, word]
        flags = np.unpackbits(rows.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(flags)
        return queries[query[which]], word[which] * 64 + bit

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of numbers of words one edit apart, in both orders."""
        order = np.argsort(self.lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(self.lengths[order])) + 1
        left, right = [], []
        step = max(1, (1 << 18) // self.width)
        for part in np.split(order, cuts):
            for begin in range(0, len(part), step):
                a, b = self.near(part[begin : begin + step])
                left.append(a)
                right.append(b)
        return np.concatenate(left), np.concatenate(right)


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[int]]]:
    """Whole groups of at least two words, several in one portion up to WORDS and HELD."""
    words: list[str] = []
    counts: list[int] = []
    held = begin = 0
    last = None
    for batch in batches:
        for key, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if key != last:
                if len(words) - begin == 1:
                    held -= len(words.pop())
                    counts.pop()
                if words and (len(words) >= WORDS or held >= HELD):
                    yield words, counts
                    words, counts, held = [], [], 0
                begin, last = len(words), key
            words.append(word)
            counts.append(n)
            held += len(word)
    if len(words) - begin == 1:
        words.pop()
        counts.pop()
    if words:
        yield words, counts


def near_words(words: DataFrame, pieces: int = PIECES, crowd: int = CROWD) -> DataFrame:
    """(word, near, near_n): each ordered pair of words one edit apart, once."""
    ship(words.sparkSession)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, counts in portions(batches):
            # A word is there once for each of its groups.
            unique = dict(zip(found, counts))
            names, n = pa.array(list(unique), pa.string()), np.fromiter(unique.values(), np.int64)
            left, right = LetterIndex(list(unique)).pairs()
            for at in range(0, len(left), 1 << 16):
                a, b = left[at : at + (1 << 16)], right[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(a)), names.take(pa.array(b)), pa.array(n[b])],
                    ["word", "near", "near_n"],
                )

    return (
        grouped(words, pieces, crowd)
        .repartition("key")
        .sortWithinPartitions("key")
        .select("key", "word", "n")
        .mapInArrow(match, "word string, near string, near_n long")
        .dropDuplicates(["word", "near"])
    )


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of a vocabulary (word, n).

    Words are near if they differ by exactly one inserted, deleted or replaced code point. A word's
    form is its near word of the largest n, of equal n the first in code-point order, where that n is
    at least `ratio` times its own; else missing. root is the last word that forms lead to, the word
    itself without a form. Words must differ and not be missing; the empty vocabulary gives no rows.
    """
    words = durable(words.select("word", "n"))
    best = (
        near_words(words)
        .groupBy("word")
        .agg(
            F.count("*").alias("n_near"),
            # Largest n, then the first word.
            F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
        )
    )
    named = -F.col("best.less") >= ratio * F.col("n")
    found = durable(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(named, F.col("best.near")).alias("form"),
            F.when(named, -F.col("best.less")).alias("form_n"),
        )
    )
    return found.join(roots(found.filter("form IS NOT NULL").select("word", "form")), "word", "left").withColumn(
        "root", F.coalesce("root", "word")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form, each round following twice as many forms at once.

    A form has a multiple of its word's occurrences, so a chain is a few dozen words at most.
    """
    at = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = durable(at.join(further, "root", "left"))
        if joined.filter("next IS NOT NULL").isEmpty():
            return at
        at = joined.select("word", F.coalesce("next", "root").alias("root"))


def document_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word): the runs of letters of all texts, some of them misspelled by rule.

    A missing or empty text has none, repeated rows count again, a missing doc_id hashes as empty.
    Other columns are not read.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(runs(text)).alias("run")).select(
        misspelled(F.col("run"), F.col("doc_id")).alias("word")
    )
