"""Repeated passages: byte strings of a given length that stand in several places, by suffix order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.skew import lookup_join

from .anchors import Anchors
from .common import durable, fingerprint, ship, whole_text

STRETCH = 200
#: Contexts of one anchor that a task compares at once; more are cut into halves first.
CROWD = 2048
#: Stretches sorted at once, several anchors together.
SORTED = 1 << 16
#: Bits of a filter per key, and bits at most (32 MB); a full filter only saves less.
BITS_EACH, MOST_BITS = 16, 1 << 28
KEY = ["k1", "k2"]


def smaller_before(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Length shared with the nearest entry before that has a smaller position, 0 without one.

    common[i] is what entries i - 1 and i share. Every round all links that still point to a larger
    position jump on, so that runs are crossed in steps that double.
    """
    n = len(position)
    link = np.arange(-1, n - 1)
    shared = common.copy()
    open_ = np.flatnonzero((link >= 0) & (position[link] > position))
    while len(open_):
        over = link[open_]
        shared[open_] = np.minimum(shared[open_], shared[over])
        link[open_] = link[over]
        further = link[open_]
        open_ = open_[(further >= 0) & (position[further] > position[open_])]
    return np.where(link >= 0, shared, 0)


def longest_previous(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For suffixes in sorted order the longest factor that also starts at a smaller position.

    The nearest smaller positions on both sides in suffix order share the most; common[i] is the
    length shared by suffixes i - 1 and i, common[0] is 0.
    """
    before = smaller_before(position, common)
    after = smaller_before(position[::-1], np.concatenate([[0], common[:0:-1]]))[::-1]
    return np.maximum(before, after)


def repeated(content: np.ndarray, starts: np.ndarray, stretch: int, first_stays: bool) -> np.ndarray:
    """Which stretches at the starts equal another; or if the first stays, an earlier one."""
    rows = np.lib.stride_tricks.sliding_window_view(content, stretch)[starts]
    order = np.argsort(rows.view(f"V{stretch}").ravel(), kind="stable")
    rows = rows[order]
    differs = rows[1:] != rows[:-1]
    common = np.zeros(len(starts), np.int64)
    common[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), stretch)
    factor = longest_previous(order, common)
    if not first_stays:
        # The same with positions turned round: what starts at a larger one.
        factor = np.maximum(factor, longest_previous(-order, common))
    out = np.zeros(len(starts), bool)
    out[order] = factor >= stretch
    return out


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id and whole text, with two numbers that name the row; rows with both alike are one."""
    number = F.col(doc_id).cast("long")
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(number, F.lit(-(1 << 63))).alias("k1"),
        fingerprint(number.isNull(), whole_text(text)).alias("k2"),
        whole_text(text).alias("text"),
    )


class Bits:
    """A set of 64-bit keys as bits, some keys too many; of a size that is bounded."""

    def __init__(self, keys: DataFrame, key: str):
        count = keys.count()
        self.size = 1 << 16
        while self.size < min(count * BITS_EACH, MOST_BITS):
            self.size *= 2
        words = (
            keys.select(F.pmod(F.col(key), F.lit(self.size)).alias("bit"))
            .groupBy(F.expr("bit div 64").alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
            .toArrow()
        )
        bits = np.zeros(self.size // 64, np.int64)
        bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        self.bits = bits.view(np.uint64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        bit = keys & (self.size - 1)
        return (self.bits[bit // 64] >> (bit % 64).astype(np.uint64)) & np.uint64(1) == 1


_anchors: dict[int, Anchors] = {}


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of strings or binaries, and where each begins and ends."""
    wide = column.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    held = wide.buffers()[2]
    return np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8), offsets


def occurrences(rows: DataFrame, stretch: int, only: Bits | None = None) -> DataFrame:
    """(anchor, context, k1, k2, begin, end, place) of all anchors, or of those in the filter."""
    spark = rows.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(only)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, wanted = _anchors.setdefault(stretch, Anchors(stretch)), held.value
        for batch in batches:
            content, offsets = bytes_of(batch.column("text"))
            text, *found = own.find(content, offsets)
            if wanted is not None:
                stays = np.flatnonzero(wanted.has(found[0]))
                text, found = text[stays], [c[stays] for c in found]
            text = pa.array(text)
            keys = [batch.column(k).take(text) for k in KEY]
            anchor, context, *bounds = found
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(context), *keys, *(pa.array(b.astype(np.int32)) for b in bounds)],
                ["anchor", "context", *KEY, "begin", "end", "place"],
            )

    return rows.select(*KEY, "text").mapInArrow(
        find, "anchor long, context long, k1 long, k2 long, begin int, end int, place int"
    )


def packed(rows: DataFrame, only: Bits) -> DataFrame:
    """Adds n_bytes, sha256 and, for rows in the filter of k2, the text compressed; drops the text."""
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast(only)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            content, offsets = bytes_of(batch.column("text"))
            wanted = held.value.has(batch.column("k2").to_numpy())
            bounds = offsets.tolist()
            digests, blobs = [], []
            for i, wants in enumerate(wanted.tolist()):
                own = content[bounds[i] : bounds[i + 1]].tobytes()
                digests.append(hashlib.sha256(own).hexdigest())
                blobs.append(codec.compress(own, asbytes=True) if wants else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", *KEY)), pa.array(np.diff(offsets)),
                    pa.array(digests, pa.string()), pa.array(blobs, pa.binary()),
                ],
                ["doc_id", *KEY, "n_bytes", "sha256", "packed"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        pack, f"doc_id {kind}, k1 long, k2 long, n_bytes long, sha256 string, packed binary"
    )


def with_content(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted places (anchor, k1, k2, begin, end, place) with their bytes, the texts moved once."""
    needs = durable(
        wanted.groupBy(*KEY).agg(
            F.collect_list(F.struct("anchor", "begin", "end", "place", "n", "contexts")).alias("needs")
        )
    )
    only = Bits(needs, "k2")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            needs = batch.column("needs")
            sizes = needs.value_lengths().to_numpy()
            owner = np.repeat(np.arange(len(batch)), sizes)
            flat = needs.flatten()
            anchor, begin, end, place, n, contexts = flat.flatten()
            blobs, lengths = batch.column("packed"), batch.column("n_bytes").to_pylist()
            begins, ends = begin.to_pylist(), end.to_pylist()
            parts, at = [], 0
            for i, size in enumerate(sizes.tolist()):
                own = codec.decompress(blobs[i].as_py(), lengths[i], asbytes=True)
                parts += [own[b:e] for b, e in zip(begins[at : at + size], ends[at : at + size])]
                at += size
            keys = [batch.column(k).take(pa.array(owner)) for k in KEY]
            yield pa.RecordBatch.from_arrays(
                [anchor, *keys, begin, place, n, contexts, pa.array(parts, pa.binary())],
                ["anchor", *KEY, "begin", "place", "n", "contexts", "content"],
            )

    texts = packed(rows, only).filter("packed IS NOT NULL").select(*KEY, "n_bytes", "packed")
    # A repeated row would bring its places twice.
    texts = texts.groupBy(*KEY).agg(F.first("n_bytes").alias("n_bytes"), F.first("packed").alias("packed"))
    return texts.join(needs, KEY).mapInArrow(
        cut,
        "anchor long, k1 long, k2 long, begin int, place int, n long, contexts long, content binary",
    )


def compared(contexts: DataFrame, stretch: int, first_stays: bool) -> DataFrame:
    """(k1, k2, begin, end): covered parts of contexts (anchor, k1, k2, begin, n, content).

    All contexts of an anchor are compared in one task, in suffix order.
    """
    ship(contexts.sparkSession)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in anchor_groups(batches, stretch):
            part = part.sort_by([("k1", "ascending"), ("k2", "ascending"), ("begin", "ascending")])
            content, offsets = bytes_of(part.column("content").combine_chunks())
            low, sizes = offsets[:-1], np.diff(offsets) - stretch + 1
            ends = np.cumsum(sizes)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            within = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
            marked = repeated(content, low[owner] + within, stretch, first_stays)
            if not first_stays:
                # Contexts that stand in several places are covered as a whole elsewhere.
                marked &= part.column("n").to_numpy()[owner] == 1
            at = np.flatnonzero(marked)
            if not len(at):
                continue
            opens = np.flatnonzero((np.diff(at, prepend=-2) > 1) | (np.diff(owner[at], prepend=-1) > 0))
            closes = np.concatenate([opens[1:], [len(at)]]) - 1
            first, final = at[opens], at[closes]
            row = pa.array(owner[first])
            begin = part.column("begin").to_numpy()[owner[first]]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(k).combine_chunks().take(row) for k in KEY),
                    pa.array((begin + within[first]).astype(np.int32)),
                    pa.array((begin + within[final] + stretch).astype(np.int32)),
                ],
                [*KEY, "begin", "end"],
            )

    return (
        contexts.select("anchor", *KEY, "begin", "n", "content")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(settle, "k1 long, k2 long, begin int, end int")
    )


def anchor_groups(batches: Iterator[pa.RecordBatch], stretch: int) -> Iterator[pa.Table]:
    """Whole groups of rows with one anchor, together up to about SORTED stretches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        anchor = batch.column("anchor").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(anchor)) + 1).tolist(), len(anchor)]
        lengths = bytes_of(batch.column("content"))[1]
        for begin, end in zip(cuts, cuts[1:]):
            if begin == end:
                continue
            opens = not held or held[-1].column("anchor")[-1].as_py() != anchor[begin]
            if opens and size >= SORTED:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch.slice(begin, end - begin))
            size += int(lengths[end] - lengths[begin]) - (end - begin) * (stretch - 1)
    if held:
        yield pa.Table.from_batches(held)


def halves(contexts: DataFrame, stretch: int) -> DataFrame:
    """Contexts cut in two by the distance of their stretches' starts to the anchor.

    Distances from `low` to `high` occur; the stretches of a half have a core in common, whose hash
    makes a finer anchor, and equal ones are in the same half. Where one distance is left, the core
    is the stretch.
    """
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    parts = F.array(
        F.struct("low", middle.alias("high")), F.struct((middle + 1).alias("low"), F.col("high"))
    )
    cut = (
        contexts.withColumn("half", F.explode(parts))
        .filter("half.low <= half.high")
        .withColumn("from", F.expr("greatest(half.low, -place)"))
        .withColumn("to", F.expr(f"least(half.high, octet_length(content) - {stretch} - place)"))
        .filter("from <= to")
        .selectExpr(
            "anchor", *KEY, "half.*", "begin + from + place AS begin", "-from AS place",
            f"substring(content, from + place + 1, to - from + {stretch}) AS content",
        )
    )
    core = F.expr(f"substring(content, high + place + 1, {stretch} - high + low)")
    return cut.select(
        fingerprint(F.col("anchor"), F.col("low"), core, salt=7).alias("anchor"),
        fingerprint(F.col("place"), F.col("content"), salt=8).alias("context"), *KEY, "begin",
        (F.col("begin") + F.octet_length("content")).cast("int").alias("end"),
        "place", "low", "high", "content",
    )


def grouped(found: DataFrame, *more: str) -> DataFrame:
    """(anchor, context, n, first): equal contexts together, combined before the shuffle."""
    place = F.struct(*KEY, "begin", "end", "place", *more)
    return found.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(place).alias("first"))


def several(groups: DataFrame, found: DataFrame, first_stays: bool) -> DataFrame:
    """(k1, k2, begin, end) of all places, or all but the first, of contexts with several."""
    often = groups.filter("n > 1").select(
        "anchor", "context", *(F.col(f"first.{c}").alias(f"first_{c}") for c in (*KEY, "begin"))
    )
    places = found.select("anchor", "context", *KEY, "begin", "end")
    out = lookup_join(places, often, ["anchor", "context"], "inner")
    if first_stays:
        out = out.filter("NOT (k1 = first_k1 AND k2 = first_k2 AND begin = first_begin)")
    return out.select(*KEY, "begin", "end")


def mixed(groups: DataFrame) -> DataFrame:
    """A place of each context whose anchor has several contexts, with their number."""
    anchors = groups.groupBy("anchor").agg(F.count("*").alias("contexts")).filter("contexts > 1")
    return lookup_join(groups, anchors, ["anchor"], "inner").select("anchor", "first.*", "n", "contexts")


def repeated_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stretch: int = STRETCH,
    first_stays: bool = True,
    crowd: int = CROWD,
) -> DataFrame:
    """(k1, k2, begin, end): parts of texts, in bytes, covered by repeated stretches.

    Equal stretches choose equal anchors. Anchors found once are done with; of the others, contexts
    that equal another as a whole are covered, and the different contexts of one anchor are compared
    byte by byte in suffix order. Contexts of an anchor with more than `crowd` are first cut into
    halves with finer anchors, again and again, so that no task compares more at once.
    """
    rows = keyed(docs, doc_id, text)
    twice = durable(
        occurrences(rows, stretch)
        .groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    )
    found = occurrences(rows, stretch, Bits(twice, "anchor"))
    groups = durable(grouped(found))
    spans = [durable(several(groups, found, first_stays))]
    chosen = durable(mixed(groups))
    contexts = with_content(rows, chosen).withColumns(
        {"low": F.lit(Anchors(stretch).size - stretch), "high": F.lit(0)}
    )
    while not chosen.filter(F.col("contexts") > crowd).isEmpty():
        contexts = durable(contexts)
        few = contexts.filter(F.col("contexts") <= crowd)
        spans.append(durable(compared(few, stretch, first_stays)))
        found = durable(halves(contexts.filter(F.col("contexts") > crowd), stretch))
        groups = durable(grouped(found, "low", "high", "content"))
        spans.append(durable(several(groups, found, first_stays)))
        contexts = chosen = durable(mixed(groups))
    spans.append(durable(compared(contexts, stretch, first_stays)))
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stretch: int = STRETCH,
    first_stays: bool = True,
    crowd: int = CROWD,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept.

    Texts are their UTF-8 bytes. Every byte is removed that is covered by a string of `stretch` bytes
    which also starts elsewhere, in the same text or another; with `first_stays` only where it starts
    earlier, texts ascending by doc_id (a missing one first, equal ones by a hash of the text). All is
    judged on the texts as they are. n_spans counts the removed runs; kept holds the remaining bytes,
    which need not be whole characters, and is missing where nothing is removed.

    A missing or empty text has no bytes, one shorter than `stretch` keeps all. Rows that share
    doc_id and text are copies of each other; with `first_stays` they are kept or cut alike. Other
    columns are not read. The empty table gives no rows. Contexts are taken to be equal where their
    128 bits of hash are.
    """
    rows = keyed(docs, doc_id, text)
    spans = durable(
        repeated_spans(docs, doc_id, text, stretch, first_stays, crowd)
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    )
    texts = packed(rows, Bits(spans, "k2"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            digests, removed, numbers, kept = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("n_bytes", "sha256", "spans"))
            for i, (size, digest, spans) in enumerate(zip(*columns)):
                blob = batch.column("packed")[i].as_py()
                own = None if blob is None else codec.decompress(blob, size, asbytes=True)
                parts, end, runs, gone = [], 0, 0, 0
                for begin, stop in sorted((s["begin"], s["end"]) for s in spans or ()):
                    if begin > end or not runs:
                        runs += 1
                        parts.append(own[end:begin])
                        end = begin
                    if stop > end:
                        gone += stop - end
                        end = stop
                rest = own if own is None else b"".join(parts) + own[end:]
                digests.append(hashlib.sha256(rest).hexdigest() if runs else digest)
                removed.append(gone)
                numbers.append(runs)
                kept.append(rest if runs else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()),
                    pa.array(numbers, pa.int64()), pa.array(digests, pa.string()),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = lookup_join(texts, spans, KEY).mapInArrow(
        remove,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
    return out.withColumnRenamed("doc_id", doc_id)
