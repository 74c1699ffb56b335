"""Language identification by interpolated Kneser-Ney character models.

Models that take at most MODEL_BYTES go to the workers as sorted arrays; larger ones stay a table,
which is joined with the different grams of the texts. Both ways give the same numbers.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from .bpe import portions
from .common import durable, ship

ORDER = 4
#: Bits of a slot. With all 64 a gram has a slot of its own: XXH64 of eight bytes is one-to-one.
BITS = 64
GAP = 32
#: What a letter has that no model has seen in any context, before it is discounted.
FLOOR = 1 / 65536
#: So much of models goes through the driver and to each worker at most.
MODEL_BYTES = 1 << 30
#: One labelled row in so many is kept from the models and sets limits and temperature.
ASIDE = 16
#: Of the labelled rows of a language so many have a cross-entropy below its limit.
ACCEPTED = 0.995
TEMPERATURES = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0)
UNKNOWN = "und"
#: The primes of XXH64.
XXH64 = (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
    0x27D4EB2F165667C5,
)


def folding() -> np.ndarray:
    """What each code point counts as: its lower case if it is a letter, else a gap."""
    out = np.full(0x110000, GAP, np.uint32)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for c in regex.findall(r"\p{L}", every):
        low = c.lower()
        out[ord(c)] = ord(low if len(low) == 1 else c)
    return out


_tables: dict[str, np.ndarray] = {}


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The packed ORDER-grams of all texts, 16 bits a letter, and the text each belongs to.

    Other characters are gaps, runs of them one; before a text stand gaps. A letter beyond the basic
    plane counts as two, the halves that UTF-16 writes it in.
    """
    if "fold" not in _tables:
        _tables["fold"] = folding()
    points = np.frombuffer("\0".join(["", *texts]).encode("utf-32-le"), np.uint32)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    of = np.repeat(np.arange(len(texts)), lengths)
    letters = _tables["fold"][points]
    gap = letters == GAP
    opens = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
    keep = ~(gap & np.concatenate([[False], gap[:-1]])) | opens
    letters, of, opens = letters[keep].astype(np.uint64), of[keep], opens[keep]
    wide = letters > np.uint64(0xFFFF)
    if wide.any():
        at = np.repeat(np.arange(len(letters)), 1 + wide)
        second = np.concatenate([[False], at[1:] == at[:-1]])
        letters, of, opens, wide = letters[at], of[at], opens[at], wide[at]
        over = letters - np.uint64(0x10000)
        high, low = over >> np.uint64(10), over & np.uint64(0x3FF)
        halves = np.where(second, np.uint64(0xDC00) | low, np.uint64(0xD800) | high)
        letters = np.where(wide, halves, letters)
    index = np.arange(len(letters))
    within = index - np.maximum.accumulate(np.where(opens, index, 0))
    packed = letters.copy()
    for back in range(1, ORDER):
        earlier = np.full(len(letters), GAP, np.uint64)
        earlier[back:] = np.where(within[back:] >= back, letters[:-back], GAP)
        packed |= earlier << np.uint64(16 * back)
    own = within > 0
    return packed[own], of[own]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text); a task adds up before it sends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            rows: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows.setdefault(lang, []).append(text or "")
            for lang, texts in rows.items():
                parts = held.setdefault(lang, [])
                for run in portions(texts):
                    keys, n = np.unique(grams(run)[0], return_counts=True)
                    parts.append((keys, n))
                    if len(parts) >= 8:
                        parts[:] = [_merged(parts)]
        for lang, parts in held.items():
            keys, n = _merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                ["lang", "gram", "n"],
            )

    return (
        labelled.select("lang", "text")
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )


def slot(keys: np.ndarray) -> np.ndarray:
    """Where a gram has its numbers: the top BITS of Spark's xxhash64 of the packed gram.

    XXH64 of eight bytes with Spark's seed 42; the constants are the algorithm's.
    """
    p1, p2, p3, p4, p5 = map(np.uint64, XXH64)

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    x = np.uint64(42 + 8) + p5 ^ turned(keys.astype(np.uint64) * p2, 31) * p1
    x = turned(x, 27) * p1 + p4
    x = (x ^ (x >> np.uint64(33))) * p2
    x = (x ^ (x >> np.uint64(29))) * p3
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(64 - BITS)).astype(np.int64)


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(part, grams, lang, slot, value): discounted shares ('share') and what is left ('left').

    The highest order uses counts, each lower one the number of different letters seen before a
    gram. The discount of an order and language is n1 / (n1 + 2 * n2), of grams seen once and twice.
    """
    level, parts = counts, []
    for order in range(ORDER, 0, -1):
        context = F.shiftrightunsigned("gram", 16) if order > 1 else F.lit(0).cast("long")
        once = F.count_if(F.col("n") == 1) + 1
        discounts = level.groupBy("lang").agg(
            (once / (once + 2 * (F.count_if(F.col("n") == 2) + 1))).alias("discount")
        )
        rows = level.withColumn("context", context)
        sums = (
            rows.groupBy("lang", "context")
            .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
            .join(discounts, "lang")
        )
        parts += [
            rows.join(sums, ["lang", "context"]).select(
                F.lit("share").alias("part"), F.lit(order).alias("grams"), "lang", F.col("gram").alias("key"),
                ((F.col("n") - F.col("discount")) / F.col("total")).alias("value"),
            ),
            sums.select(
                F.lit("left").alias("part"),
                F.lit(order).alias("grams"),
                "lang",
                F.col("context").alias("key"),
                (F.col("discount") * F.col("kinds") / F.col("total")).alias("value"),
            ),
        ]
        if order > 1:
            level = (
                level.withColumn("gram", F.col("gram").bitwiseAND(F.lit((1 << (16 * (order - 1))) - 1)))
                .groupBy("lang", "gram")
                .agg(F.count(F.lit(1)).alias("n"))
            )
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)

    return (
        every.withColumn("slot", F.shiftrightunsigned(F.xxhash64("key"), 64 - BITS))
        .groupBy("part", "grams", "lang", "slot")
        .agg(F.max("value").alias("value"))
    )


class Models:
    """The models of all languages side by side: for each order sorted slots and their numbers."""

    def __init__(self, table: pa.Table):
        part, order, lang, slots, value = (
            table.column(n).to_numpy() for n in ("part", "grams", "lang", "slot", "value")
        )
        self.langs = sorted(set(lang.tolist()))
        number = np.array([self.langs.index(x) for x in lang.tolist()], np.int64)
        self.tables = {}
        for name, absent in (("share", 0.0), ("left", 1.0)):
            for n in range(1, ORDER + 1):
                at = (part == name) & (order == n)
                known, row = np.unique(slots[at], return_inverse=True)
                numbers = np.full((len(known) + 1, max(1, len(self.langs))), absent)
                numbers[row, number[at]] = value[at]
                self.tables[name, n] = (known, numbers)

    def look(self, name: str, order: int, keys: np.ndarray) -> np.ndarray:
        known, numbers = self.tables[name, order]
        slots = slot(keys)
        place = np.searchsorted(known, slots)
        place[place == len(known)] = 0
        found = known[place] == slots if len(known) else np.zeros(len(slots), bool)
        return numbers[np.where(found, place, len(known))]

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """-log2 of the probability of each gram's last letter, per language."""
        p = np.full((len(keys), max(1, len(self.langs))), FLOOR)
        for order in range(1, ORDER + 1):
            own = keys & np.uint64((1 << (16 * order)) - 1)
            context = own >> np.uint64(16)
            p = self.look("share", order, own) + self.look("left", order, context) * p
        return -np.log2(np.maximum(p, 1e-300))

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text under each language, and its number of characters."""
        keys, of = grams(texts)
        some, place = np.unique(keys, return_inverse=True)
        bits = self.bits(some)
        size = np.bincount(of, minlength=len(texts))
        sums = np.stack(
            [
                np.bincount(of, weights=bits[place, i], minlength=len(texts))
                for i in range(bits.shape[1])
            ],
            axis=1,
        )
        return sums / np.maximum(size, 1)[:, None], size


_models: dict[int, Models] = {}


def models_of(content: bytes) -> Models:
    key = hash(content)
    if key not in _models:
        _models.clear()
        _models[key] = Models(pa.ipc.open_file(io.BytesIO(content)).read_all())
    return _models[key]


def fitted(labelled: DataFrame) -> DataFrame:
    """The models of all languages in (lang, text), as a stored table; it grows with the different grams."""
    ship(labelled.sparkSession)
    counts = durable(gram_counts(labelled.filter("lang IS NOT NULL AND text IS NOT NULL")))
    return durable(kneser_ney(counts))


def packed(models: DataFrame) -> bytes:
    """The models as Arrow file content, for the workers."""
    table = models.toArrow()
    out = io.BytesIO()
    with pa.ipc.new_file(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue()


def bytes_at_most(models: DataFrame) -> int:
    """A bound on what the models take in a worker: file content, slots and a number per language."""
    rows, langs = models.agg(F.count(F.lit(1)), F.count_distinct("lang")).first()
    return rows * (40 + 8 * langs)


def lettered(text: str) -> bool:
    """Gaps alone are no letters: a text's grams then are a single gap at most."""
    return bool(regex.search(r"\p{L}", text))


def scored(
    docs: DataFrame, models: DataFrame, text: str = "text", entropies: str = "entropies", most: int = MODEL_BYTES
) -> DataFrame:
    """Adds a map from language to bits per character; empty without letters or models.

    Models of at most `most` bytes are broadcast, others joined.
    """
    ship(docs.sparkSession)
    if bytes_at_most(models) <= most:
        return scored_by_arrays(docs, packed(models), text, entropies)
    return scored_by_join(docs, models, text, entropies)


def scored_by_arrays(docs: DataFrame, models: bytes, text: str, entropies: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("map<string,double>")
    def score(column: pa.Array) -> pa.Array:
        own = models_of(held.value)
        out = []
        for run in portions(["" if t is None else t for t in column.to_pylist()]):
            per, size = own.entropies(run)
            some = np.array([lettered(t) for t in run])
            out += [
                list(zip(own.langs, row)) if ok and own.langs else []
                for row, ok in zip(per.tolist(), (some & (size > 0)).tolist())
            ]
        return pa.array(out, pa.map_(pa.string(), pa.float64()))

    return docs.withColumn(entropies, score.asNondeterministic()(F.col(text)))


def row_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, gram, n) of rows of (at, text): the different grams of each text that has letters."""
    for batch in batches:
        texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
        first = 0
        for run in portions(texts):
            at = np.asarray(batch.column(0))[first : first + len(run)]
            first += len(run)
            keys, of = grams([t if lettered(t) else "" for t in run])
            order = np.lexsort((keys, of))
            keys, of = keys[order], of[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
            starts = np.flatnonzero(new)
            n = np.diff(np.append(starts, len(keys)))
            for i in range(0, len(starts), 1 << 16):
                some = starts[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[of[some]]), pa.array(keys[some].view(np.int64)), pa.array(n[i : i + (1 << 16)])],
                    ["at", "gram", "n"],
                )


def gram_bits(used: DataFrame, models: DataFrame) -> tuple[DataFrame, list[str]]:
    """(gram, bits): -log2 of the probability of each gram's last letter, per language; the languages.

    From single letters up, each order's probabilities are joined to the grams one letter longer. A
    key has as many partners as there are letters, so no key grows with the input.
    """

    def numbers(part: str, order: int, name: str) -> DataFrame:
        return (
            models.filter((F.col("part") == part) & (F.col("grams") == order))
            .groupBy("slot")
            .agg(F.map_from_entries(F.collect_list(F.struct("lang", "value"))).alias(name))
        )

    def slot_of(key: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(key), 64 - BITS)

    # A number per language: what single letters leave.
    left = {
        r["lang"]: r["value"]
        for r in models.filter((F.col("part") == "left") & (F.col("grams") == 1)).select("lang", "value").collect()
    }
    langs = sorted(left)
    lower = F.map_from_arrays(
        F.array(*map(F.lit, langs)), F.array(*(F.lit(left[x] * FLOOR) for x in langs))
    )
    known = None
    for order in range(1, ORDER + 1):
        mask = (1 << (16 * order)) - 1
        rows = used.select((F.col("gram").bitwiseAND(F.lit(mask)) if order < ORDER else F.col("gram")).alias("key"))
        rows = rows.distinct().withColumn("slot", slot_of(F.col("key")))
        rows = rows.join(numbers("share", order, "shares"), "slot", "left")
        if known is None:
            p = F.transform_values(lower, lambda x, q: F.coalesce(F.try_element_at("shares", x), F.lit(0.0)) + q)
        else:
            rows = rows.withColumn("shorter", F.col("key").bitwiseAND(F.lit(mask >> 16)))
            rows = rows.withColumn("slot", slot_of(F.shiftrightunsigned("key", 16)))
            rows = rows.join(numbers("left", order, "lefts"), "slot", "left").join(known, "shorter")
            p = F.transform_values(
                "p",
                lambda x, q: F.coalesce(F.try_element_at("shares", x), F.lit(0.0))
                + F.coalesce(F.try_element_at("lefts", x), F.lit(1.0)) * q,
            )
        known = rows.select(F.col("key").alias("shorter"), p.alias("p"))
    bits = F.transform_values("p", lambda x, q: -F.log2(F.greatest(q, F.lit(1e-300))))
    return known.select(F.col("shorter").alias("gram"), bits.alias("bits")), langs


def scored_by_join(docs: DataFrame, models: DataFrame, text: str, entropies: str) -> DataFrame:
    """The different grams of each text, by the shared folder, meet their bits in a join that can be split."""
    at = "at"
    while at in docs.columns:
        at += "_"
    rows = durable(docs.withColumn(at, F.monotonically_increasing_id()))
    found = durable(
        rows.select(F.col(at).alias("at"), F.col(text).alias("text")).mapInArrow(row_grams, "at long, gram long, n long")
    )
    bits, langs = gram_bits(found.select("gram").distinct(), models)
    size = F.sum("n")
    per = F.map_from_arrays(
        F.array(*map(F.lit, langs)).cast("array<string>"),
        F.array(*(F.sum(F.col("n") * F.col("bits")[x]) / size for x in langs)).cast("array<double>"),
    )
    sums = lookup_join(found, bits, ["gram"], "inner").groupBy("at").agg(per.alias(entropies))
    none = F.create_map().cast("map<string,double>")
    return (
        rows.withColumn("__at", F.col(at)).drop(at)
        .join(sums.withColumnRenamed("at", "__at"), "__at", "left")
        .select(*(F.col(f"`{c}`") for c in docs.columns), F.coalesce(F.col(entropies), none).alias(entropies))
    )


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def set_aside(doc_id: Column) -> Column:
    """One row in ASIDE of those not held out, by the higher bits of the same number."""
    return F.floor(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) / 4) % ASIDE == 0


def identified(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MODEL_BYTES
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, bits and accepted.

    Models are learned from text and label of all documents that are not held out and have both, but
    for one in ASIDE; these give temperature and limits, those learned from do for a language (or a
    table) that has none set aside. A language is learned if any of its rows is not set aside. Models
    over `most` bytes stay a table. lang_pred has the lowest bits per character, the alphabetically
    first of equal ones; `und` without letters, without text, or when nothing was learned. score is
    its probability: a softmax over -bits whose temperature fits the labels set aside best. accepted
    is false where bits are above what ACCEPTED of that language's own documents set aside have, so
    for texts in none of the languages. Repeated rows fare alike; a missing doc_id is not held out; the empty table gives
    none. Label and source are no inputs of a prediction.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"),
        held_out(F.col(doc_id)).alias("held_out"), set_aside(F.col(doc_id)).alias("aside"),
    )
    models = fitted(rows.filter("NOT held_out AND NOT aside").select("lang", "text"))
    best = F.array_min(
        F.transform(
            F.map_entries("entropies"), lambda e: F.struct(e["value"].alias("bits"), e["key"].alias("lang"))
        )
    )
    results = durable(
        scored(rows, models, most=most).drop("text").withColumn("best", best)
    )

    def chance(of: Column, temperature: Column) -> Column:
        """Softmax over -bits, each against the lowest."""
        low = F.col("best.bits")
        total = F.aggregate(
            F.map_values("entropies"), F.lit(0.0), lambda a, b: a + F.exp((low - b) * temperature)
        )
        return F.exp((low - of) * temperature) / total

    learned = results.filter("NOT held_out AND lang IS NOT NULL AND best IS NOT NULL")
    own = F.try_element_at("entropies", F.col("lang"))
    fits = learned.select(
        *(
            F.coalesce(F.avg(F.when(F.col("aside"), loss)), F.avg(loss))
            for loss in (
                -F.log(F.greatest(chance(own, F.lit(t)), F.lit(1e-12))) for t in TEMPERATURES
            )
        )
    ).first()
    loss = [x if x is not None else 0.0 for x in fits]
    temperature = TEMPERATURES[loss.index(min(loss))]
    limits = learned.groupBy(F.col("lang").alias("lang_pred")).agg(
        F.coalesce(
            F.percentile_approx(F.when(F.col("aside"), own), F.lit(ACCEPTED), F.lit(1000)),
            F.percentile_approx(own, F.lit(ACCEPTED), F.lit(1000)),
        ).alias("most")
    )
    results = results.withColumn("lang_pred", F.coalesce(F.col("best.lang"), F.lit(UNKNOWN)))
    return (
        lookup_join(results, limits, ["lang_pred"])
        .select(
            "doc_id",
            "held_out",
            "lang_pred",
            F.coalesce(chance(F.col("best.bits"), F.lit(temperature)), F.lit(0.0)).alias("score"),
            F.col("best.bits").alias("bits"),
            F.coalesce(F.col("best.bits") <= F.col("most"), F.lit(False)).alias("accepted"),
        )
    )
