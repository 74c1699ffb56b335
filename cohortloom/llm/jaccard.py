"""Near-duplicate documents by a parity-sketch join on word shingles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.skew import lookup_join

from .bpe import portions
from .common import durable, ship

#: Words in a shingle, and the similarity of a link in hundredths.
WORDS, PERCENT = 5, 80
#: The least numbers of 64 bits in a sketch; larger sets have wider ones.
SKETCH = 16
#: Documents around one first document that a join may pair, and of a block where there are more.
#: One with a wider sketch counts as several.
FEW, BLOCK = 64, 4096
#: Keys among which a task looks for those that its documents share, before it sends them on.
HELD = 1 << 20
FACTOR = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = x ^ _U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> _U(shift))) * _U(factor)
    return x ^ (x >> _U(31))


_fixed: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """factor ** i and factor ** -i modulo 2 ** 64, for i up to n."""
    if len(_fixed.get("up", ())) < n + 1:
        factor = 0x9E3779B97F4A7C15
        for name, base in (("up", factor), ("down", pow(factor, -1, 1 << 64))):
            row = np.full(n + 1, base, _U)
            row[0] = 1
            _fixed[name] = np.multiply.accumulate(row)
    return _fixed["up"], _fixed["down"]


def shingle_sets(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, ascending in each, and how many each has.

    Words are what blank and tab to return separate, A-Z in lower case. A text with fewer words is
    one shingle, without words it has none.
    """
    if "low" not in _fixed:
        low = np.arange(256, dtype=np.uint8)
        low[65:91] += 32
        space = np.zeros(256, bool)
        space[[32, *range(9, 14)]] = True
        _fixed.update(low=low, space=space, code=mixed(np.arange(256, dtype=_U), 77))
    raw = [t.encode() for t in texts]
    content = np.frombuffer(b" ".join([*raw, b""]) + b" ", np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    solid = ~_fixed["space"][content]
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    if len(solid) and solid[0]:
        edge = np.concatenate([[0], edge])
    first, stop = edge[0::2], edge[1::2]
    if not len(first):
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    up, down = _powers(len(content))
    value = _fixed["code"][_fixed["low"][content]] * up[: len(content)]
    summed = np.concatenate([np.zeros(1, _U), np.cumsum(value, dtype=_U)])
    word = mixed((summed[stop] - summed[first]) * down[first] + (stop - first).astype(_U))
    of = np.searchsorted(ends, first, "right")
    many = np.bincount(of, minlength=len(texts))
    begin = np.cumsum(many) - many
    # Full shingles begin at all but the last words of a text; a short text gives one.
    left = (begin + many)[of] - np.arange(len(word))
    at = np.flatnonzero((left >= words) | ((many[of] < words) & (left == many[of])))
    total = np.zeros(len(at), _U)
    for k in range(words):
        within = left[at] > k
        part = mixed(word[np.minimum(at + k, len(word) - 1)], k + 1)
        total = total * FACTOR + np.where(within, part, _U(0))
    shingle, of = mixed(total, 99), of[at]
    order = np.lexsort((shingle, of))
    shingle, of = shingle[order], of[order]
    new = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (of[1:] != of[:-1])])
    shingle, of = shingle[new], of[new]
    return shingle, np.bincount(of, minlength=len(texts))


class Bands:
    """Size bands and what the pigeonhole principle asks of them.

    A band ends where a linked set could be beyond the next band. Sets of band g, and those of band
    g + 1 that may be linked with them, meet in group g. Linked sets a <= b differ in at most
    a * (100 - p) / p tokens, as their union is at most a * 100 / p; the most in a group is
    `most`. A sketch of more than `most` blocks has an equal block; `spare` further ones make up
    for blocks without tokens, which are not joined on.
    """

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        bounds = [1]
        while bounds[-1] <= largest:
            bounds.append(bounds[-1] * 100 // percent + 1)
        self.bounds = np.array(bounds, np.int64)
        last = self.bounds[1:] - 1
        # |a xor b| = a + b - 2 i with i >= p (a + b) / (100 + p) and b <= 100 a / p.
        self.most = last * (100 - percent) // percent
        self.spare = 1 + self.most // 16
        self.blocks = self.most + 1 + self.spare

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, sizes, "right") - 1


def distance(a: str, b: str) -> Column:
    """In how many bits two sketches differ, the wider one folded to the width of the other."""

    def folded(of: str, width: Column) -> Column:
        return F.when(F.size(of) <= width, F.col(of)).otherwise(
            F.transform(
                F.sequence(F.lit(0), width - 1),
                lambda i: F.aggregate(
                    F.sequence(i, F.size(of) - 1, width),
                    F.lit(0).cast("long"),
                    lambda x, j: x.bitwiseXOR(F.get(of, j)),
                ),
            )
        )

    ones = F.zip_with(
        folded(a, F.size(b)), folded(b, F.size(a)), lambda x, y: F.bit_count(x.bitwiseXOR(y))
    )
    return F.aggregate(ones, F.lit(0), lambda total, x: total + x)


def like_sizes(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes may be linked at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def differing(a: Column, b: Column, percent: int) -> Column:
    """The most that linked sets of these sizes differ."""
    return F.floor((a + b) * (100 - percent) / (100 + percent)).cast("long")


def _keys(shingles: np.ndarray, sizes: np.ndarray, group: np.ndarray, bands: Bands):
    """(set, key) of every block with tokens; also which sets have too many blocks without."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    blocks = bands.blocks[group][of].astype(_U)
    # Blocks are hash ranges, so that a set's ascending hashes come block by block.
    block = ((shingles >> _U(32)) * blocks) >> _U(32)
    new = np.concatenate([[True], (of[1:] != of[:-1]) | (block[1:] != block[:-1])])
    at = np.flatnonzero(new)
    parity = np.bitwise_xor.reduceat(mixed(shingles, 5), at)
    owner = of[at]
    key = mixed(parity + mixed(block[at] + (group[owner].astype(_U) << _U(32)), 6), 7)
    filled = np.bincount(owner, minlength=len(sizes))
    # Blocks that must agree: all but the most that a partner of this size differs in.
    most = np.minimum(sizes * (100 - bands.percent) // bands.percent, bands.most[group])
    agree = bands.blocks[group] - most
    unsafe = bands.blocks[group] - filled >= agree
    return owner, key, unsafe


def join_keys(shingles: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) such that linked sets share a key, unless they are equal.

    Where so many blocks hold nothing that linked sets might agree in those only, the smallest
    hashes of the set are keys too, as many as one of which linked sets share (prefix filter).
    """
    bands = Bands(percent, int(sizes.max()) if len(sizes) else 1)
    begin = np.cumsum(sizes) - sizes
    sets, keys = [], []
    band = bands.of(np.maximum(sizes, 1))
    for lower in (0, 1):
        group = np.maximum(band - lower, 0)
        joins = (sizes > 0) & (bands.most[group] > 0) & (band >= lower)
        if lower:
            # Of the upper band only sizes that the largest set of the lower one may be linked with.
            joins &= sizes * percent <= (bands.bounds[group + 1] - 1) * 100
        number = np.flatnonzero(joins)
        if not len(number):
            continue
        flat = shingles[np.repeat(joins, sizes)]
        owner, key, unsafe = _keys(flat, sizes[number], group[number], bands)
        sets.append(number[owner])
        keys.append(key)
        for i in number[unsafe].tolist():
            n = int(sizes[i])
            prefix = shingles[begin[i] : begin[i] + n - (-(-n * percent // 100)) + 1]
            sets.append(np.full(len(prefix), i))
            keys.append(mixed(prefix, 8))
    if not sets:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(sets), np.concatenate(keys)


def _xor(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes), _U)
    some = sizes > 0
    if some.any():
        out[some] = np.bitwise_xor.reduceat(values, (np.cumsum(sizes) - sizes)[some])
    return out


def _widths(sizes: np.ndarray) -> np.ndarray:
    """How many numbers of 64 bits a set's sketch has: a power of two, with a bit per token or more.

    Linked sets a <= b differ in a / 4 tokens at most (80 %), unrelated ones in about half the bits
    of a, so that sketches tell them apart whatever their size.
    """
    need = np.maximum(SKETCH, -(-sizes // 64))
    return np.int64(1) << np.frexp(need - 1)[1].astype(np.int64)


def _sketches(shingles: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sketches of all sets one after the other, and where each begins and the last ends.

    A token flips one bit, so that equal tokens cancel in a XOR. Its place in a sketch of half the
    width is its place modulo that, so a sketch folds into narrower ones.
    """
    width = _widths(sizes)
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(width)])
    of = np.repeat(np.arange(len(sizes)), sizes)
    bit = mixed(shingles, 9)
    place = ends[of] + (bit & (width[of] - 1).astype(_U)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    out = np.zeros(ends[-1], _U)
    if len(place):
        sorted_place = place[order]
        at = np.flatnonzero(np.concatenate([[True], sorted_place[1:] != sorted_place[:-1]]))
        flips = _U(1) << (bit[order] >> _U(58))
        out[sorted_place[at]] = np.bitwise_xor.reduceat(flips, at)
    return out, ends


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches, one in a row, folded to a width."""
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def _runs(batches: Iterator[pa.RecordBatch], words: int):
    """(ids, shingles, sizes) of portions of the batches."""
    for batch in batches:
        row = 0
        for run in portions(["" if t is None else t for t in batch.column(1).to_pylist()]):
            yield batch.column(0).slice(row, len(run)), *shingle_sets(run, words)
            row += len(run)


def _batch(names: str, *columns) -> pa.RecordBatch:
    signed = (c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == _U else c for c in columns)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in signed], names.split()
    )


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2): the 128-bit fingerprint of each row's set."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, shingles, sizes in _runs(batches, words):
            yield _batch(
                "doc_id n_shingles f1 f2",
                ids, sizes, _xor(mixed(shingles, 1), sizes), _xor(mixed(shingles, 2), sizes),
            )

    # Ids that are missing are not compared; the row's text alone tells its size.
    return docs.mapInArrow(one, "doc_id long, n_shingles long, f1 long, f2 long")


def _led(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The distinct (key, doc_id), with the smallest doc_id of the key and whether it has others."""
    key, doc = (np.concatenate(column) for column in zip(*parts))
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    begins = np.concatenate([[True], k[1:] != k[:-1]])[: len(k)]
    new = begins.copy()
    new[1:] |= d[1:] != d[:-1]
    order, k, d, begins = order[new], k[new], d[new], begins[new]
    at = np.flatnonzero(begins)
    lead = d[at][np.cumsum(begins) - 1]
    many = np.repeat(np.diff(np.append(at, len(k))) > 1, np.diff(np.append(at, len(k))))
    # As they came, since neighbours are alike and so compress better.
    back = np.argsort(order)
    batch = _batch(
        "key doc_id lead many", k[back], d[back], pa.array(lead[back], mask=begins[back]), many[back]
    )
    for begin in range(0, len(batch), 1 << 16):
        yield batch.slice(begin, 1 << 16)


def keyed(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(key, doc_id, lead, many) of all sets that a task meets for the first time.

    Among some HELD keys at a time a task groups the documents that share one: `lead` is the
    smallest of them, missing for itself, and `many` tells whether there are others. So at most one
    document in a portion has to meet those of other portions, however many share the key.
    """
    held = HELD

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        parts, size = [], 0
        for ids, shingles, sizes in _runs(batches, words):
            prints = zip(
                _xor(mixed(shingles, 1), sizes).tolist(), _xor(mixed(shingles, 2), sizes).tolist()
            )
            new = np.zeros(len(sizes), bool)
            for i, p in enumerate(prints):
                if p not in met:
                    met.add(p)
                    new[i] = True
            owner, key = join_keys(shingles[np.repeat(new, sizes)], sizes[new], percent)
            parts.append((key, ids.to_numpy()[new][owner]))
            size += len(key)
            if size >= held:
                yield from _led(parts)
                parts, size = [], 0
        if parts:
            yield from _led(parts)

    return docs.mapInArrow(keys, "key long, doc_id long, lead long, many boolean")


def sets_of(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles, sketch) of each row."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, shingles, sizes in _runs(batches, words):
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            sketches, places = _sketches(shingles, sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(shingles.view(np.int64))),
                    pa.ListArray.from_arrays(
                        pa.array(places.astype(np.int32)), pa.array(sketches.view(np.int64))
                    ),
                ],
                ["doc_id", "shingles", "sketch"],
            )

    return docs.mapInArrow(one, "doc_id long, shingles array<long>, sketch array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked: sketches rule most others out, the sets decide.

    Only sets of documents in the pairs that are left, and few others, are shuffled.
    """
    small = sets.select("doc_id", "sketch", F.size("shingles").alias("n"))
    near = durable(
        pairs.join(small.toDF("a", "sketch_a", "n_a"), "a")
        .join(small.toDF("b", "sketch_b", "n_b"), "b")
        .filter(like_sizes("n_a", "n_b", percent))
        .filter(distance("sketch_a", "sketch_b") <= differing(F.col("n_a"), F.col("n_b"), percent))
        .select("a", "b", "n_a", "n_b")
    )
    ends = near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id")))
    whole = possible(sets.select("doc_id", "shingles"), ends.distinct()).filter("possible")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (
        near.join(whole.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(whole.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
        .filter(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both))
        .select("a", "b")
    )


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component): the smallest doc_id that links (a, b) reach, for linked documents.

    Large stars and small stars in turn: every node passes its smallest neighbour on, until the
    links are stars around the smallest ids. Each round is written to the shared folder.
    """
    falling = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = durable(falling.filter("u > v").distinct())

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def star(edges: DataFrame, keep: str) -> DataFrame:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        return edges.join(least, "u").filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))

    before = None
    while (now := state(links)) != before:
        before = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, "v > u").filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("v"))
        small = star(large, "v <> m").filter("u > v").unionByName(least)
        links = durable(small.distinct())
    return links.select(F.col("u").alias("doc_id"), F.col("v").alias("component"))


#: Bits of a filter per wanted id, and the most numbers of 64 bits that it has.
PER_ID, SPOTS = 16, 1 << 20
#: So many wanted ids leave a filter 8 bits for each: 12 % of the others pass at most. The sets of
#: those take less room than the texts of all would in a shuffle that leaves them out.
FILTERED = SPOTS * 64 // 8


def possible(rows: DataFrame, wanted: DataFrame, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Adds whether a row may have a wanted id (the columns `by`), so that few rows are shuffled.

    A bit for each hash of a wanted id, PER_ID bits per id rounded up to a power of two, in
    SPOTS numbers at most, some 60 MB: that and no more is broadcast. Of the other rows 6 % pass
    at most, up to 4 million ids; beyond that more do, and where all bits are set every row does.
    """
    spots, ids = 64, wanted.count()
    while spots < SPOTS and spots * 64 < PER_ID * ids:
        spots *= 2
    hashed = f"xxhash64({', '.join(by)})"
    spot = F.expr(f"{hashed} & {spots - 1}")
    bit = f"cast(shiftrightunsigned({hashed}, 58) as int)"
    bits = wanted.groupBy(spot.alias("spot")).agg(
        F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("bits")
    )
    return rows.join(F.broadcast(bits), spot == F.col("spot"), "left").select(
        *rows.columns, F.expr(f"coalesce(getbit(bits, {bit}), 0) = 1").alias("possible")
    )


def compared(met: DataFrame, joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that share a key, are in different components and whose sketches allow a link.

    Documents that share a key share its first document, so they are compared once for each such
    first document rather than for each key: those outside its component with all others. Few are
    joined; many are dealt out in blocks, of which each task compares one pair. Keys and first
    documents are looked up by joins that adaptive execution can split.

    The heads of a key's rows lead from each document to the key's first one. So a key is in
    different components where a document and its head are, and the different pairs of those, far
    fewer than the rows, tell which keys to look up.
    """
    component = F.coalesce("component", "doc_id")
    mains = joined.select(F.col("doc_id").alias("head"), F.col("component").alias("main"))
    pairs = met.filter("doc_id <> head").select("head", "doc_id").distinct()
    apart = durable(
        lookup_join(lookup_join(pairs, joined, ["doc_id"]), mains, ["head"])
        .filter(component != F.coalesce("main", "head"))
        .select("head", "doc_id")
    )
    crossing = possible(met, apart, ("head", "doc_id")).filter("possible")
    keys = durable(
        lookup_join(crossing.select("key", "head", "doc_id"), apart, ["head", "doc_id"], "inner")
        .select("key")
        .distinct()
    )
    shared = possible(met.select("key", "doc_id"), keys, ("key",)).filter("possible").drop("possible")
    heads = shared.groupBy("key").agg(F.min("doc_id").alias("head")).join(keys, "key", "left_semi")
    members = (
        lookup_join(shared, heads, ["key"], "inner")
        .select("head", "doc_id")
        .distinct()
        .join(joined, "doc_id", "left")
        .select("head", "doc_id", component.alias("component"))
        .join(sets.select("doc_id", "sketch", F.size("shingles").alias("n")), "doc_id")
    )
    members = lookup_join(members, mains, ["head"]).withColumn(
        "outside", F.col("component") != F.coalesce("main", "head")
    )
    members = durable(members.drop("main"))
    weight = (F.size("sketch") / SKETCH).cast("long")
    sizes = members.groupBy("head").agg(
        F.sum(weight).alias("members"),
        F.sum(F.when(F.col("outside"), weight).otherwise(0)).alias("outsiders"),
    )
    members = lookup_join(members, sizes, ["head"], "inner")
    columns = ("head", "doc_id", "component", "sketch", "n")

    def named(rows: DataFrame, side: str) -> DataFrame:
        return rows.select(*(F.col(c).alias(f"{c}_{side}") for c in columns), "members", "outsiders")

    left, right = named(members.filter("outside"), "a"), named(members, "b")
    few = (
        left.filter(F.col("members") <= FEW)
        .drop("members", "outsiders")
        .join(
            right.filter(F.col("members") <= FEW).drop("members", "outsiders"),
            F.col("head_a") == F.col("head_b"),
        )
        .filter("component_a <> component_b")
        .filter(like_sizes("n_a", "n_b", percent))
        .filter(distance("sketch_a", "sketch_b") <= differing(F.col("n_a"), F.col("n_b"), percent))
        .select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b"))
    )

    def dealt(rows: DataFrame, side: str, own: str, other: str) -> DataFrame:
        """Each row in its own block, for every block of the other side."""
        blocks = {c: F.ceil(F.col(c) / F.lit(BLOCK)) for c in ("members", "outsiders")}
        return (
            rows.filter(F.col("members") > FEW)
            .withColumn(own, F.pmod(F.xxhash64(f"doc_id_{side}"), blocks[own]).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), blocks[other].cast("int") - 1)))
        )

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        def by_width(t: pa.Table, side: str):
            """(doc_id, component, n, sketches) of the rows of each width."""
            lists = t.column(f"sketch_{side}").combine_chunks()
            width = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy().view(_U)
            begin = np.cumsum(width, dtype=np.int64) - width
            numbers = [t.column(f"{c}_{side}").to_numpy() for c in ("doc_id", "component", "n")]
            for w in np.unique(width).tolist():
                at = np.flatnonzero(width == w)
                yield *(x[at] for x in numbers), flat[begin[at][:, None] + np.arange(w)]

        theirs = list(by_width(two, "b"))
        firsts, seconds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for da, ca, na, wide_a in by_width(one, "a"):
            for db, cb, nb, wide_b in theirs:
                width = min(wide_a.shape[1], wide_b.shape[1])
                sa, sb = _folded(wide_a, width), _folded(wide_b, width)
                for i in range(len(da)):
                    alike = 100 * np.minimum(nb, na[i]) >= percent * np.maximum(nb, na[i])
                    at = np.flatnonzero(alike & (cb != ca[i]))
                    apart = np.bitwise_count(sb[at] ^ sa[i]).sum(axis=1, dtype=np.int64)
                    near = at[apart <= (nb[at] + na[i]) * (100 - percent) // (100 + percent)]
                    firsts.append(np.minimum(db[near], da[i]))
                    seconds.append(np.maximum(db[near], da[i]))
        return pa.table({"a": np.concatenate(firsts), "b": np.concatenate(seconds)})

    many = (
        dealt(left, "a", "outsiders", "members").groupBy("head_a", "outsiders", "members")
        .cogroup(
            dealt(right, "b", "members", "outsiders").groupBy("head_b", "outsiders", "members")
        )
        .applyInArrow(compare, "a long, b long")
    )
    return few.unionByName(many).distinct()


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document.

    A document's set holds the distinct `words`-word shingles of its whole text (see shingle_sets).
    Two documents are linked when 100 * intersection >= percent * union; component_id is the smallest
    doc_id that links reach. Sets are compared by 64-bit hashes of their shingles. Texts that are
    empty or missing have an empty set and are linked with nothing. A row without doc_id is linked
    with nothing and has no component. Rows that share a doc_id count as one document that is linked
    with whatever one of them is. Other columns are ignored. The empty table gives none.

    Equal sets are one class, found by fingerprint. Of the others, sketches of XORed token hashes
    are compared block by block, within groups of like sizes: linked sets share a block (see Bands).
    In each group of an equal block every set is first paired with the first set and the one before
    it, within portions of a task and then across portions; what that leaves in several components
    is then paired across components.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    named = rows.filter("doc_id IS NOT NULL")
    prints = durable(fingerprints(rows, words))
    first = (
        prints.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("n_shingles", "f1", "f2")
        .agg(F.min("doc_id").alias("first"))
    )
    classes = durable(
        prints.join(first, ["n_shingles", "f1", "f2"], "left").select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")).alias("first"),
        )
    )
    equal = classes.filter("doc_id > first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))

    # Those that lead a portion meet by key, the others only those of their own portion.
    order = Window.partitionBy("key", "lead").orderBy("doc_id")
    met = durable(
        keyed(named, words, percent)
        .select(
            "key",
            "doc_id",
            "lead",
            "many",
            F.coalesce("lead", F.first("doc_id").over(order)).alias("head"),
            F.coalesce(F.lag("doc_id").over(order), "lead").alias("before"),
            F.lead("doc_id").over(order).alias("after"),
        )
        .filter(
            "lead IS NOT NULL OR many OR doc_id <> head OR doc_id <> coalesce(after, doc_id)"
        )
        .drop("lead", "many", "after")
    )
    candidates = durable(
        met.select(F.col("head").alias("a"), F.col("doc_id").alias("b"))
        .unionByName(met.select(F.col("before").alias("a"), F.col("doc_id").alias("b")))
        .filter("a < b")
        .distinct()
    )
    wanted = durable(met.select("doc_id").distinct())
    near = possible(named, wanted).filter("possible").drop("possible")
    if wanted.count() > FILTERED:
        near = near.join(wanted, "doc_id", "left_semi")
    sets = durable(sets_of(near, words))
    links = durable(verified(candidates, sets, percent).unionByName(equal))
    joined = components(links)
    across = durable(compared(met, joined, sets, percent).join(candidates, ["a", "b"], "left_anti"))
    late = durable(verified(across, sets, percent))
    if not late.isEmpty():
        joined = components(links.unionByName(late))
    return classes.join(joined, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents of which none linked has a smaller doc_id, with their own columns."""
    away = durable(
        near_duplicates(docs, doc_id, text, **options)
        .filter("component_id < doc_id")
        .select("doc_id")
        .distinct()
    )
    rows = docs.select(F.struct("*").alias("document"), F.col(doc_id).cast("long").alias("doc_id"))
    marked = possible(rows, away)
    return (
        marked.filter("NOT possible")
        .drop("possible")
        .unionByName(marked.filter("possible").drop("possible").join(away, "doc_id", "left_anti"))
        .select("document.*")
    )
