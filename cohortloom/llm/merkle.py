"""Merkle manifests: one digest for a table, and a proof of each row, by pivots of slots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A pass spreads about so many nodes into the columns of one row, whatever the fanout.
SLOTS = 16


def spelled(value: Column) -> Column:
    """`-` for a missing value, else its UTF-8 byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")
    )


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other; missing ones are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Adds `place`, from 0 in each tree by `order`, and `n`, the rows of the tree.

    Rows are dealt out by range of tree and order, so that a tree may fill many tasks; a small table
    with one row per task and tree tells how many rows come before.
    """
    by = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    dealt = durable(
        rows.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("task", F.shiftright("row", 33))
    )
    whole = Window.partitionBy(tree)
    before = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(tree, "task").agg(F.min("row").alias("least"), F.count("*").alias("rows"))
    starts = starts.select(
        F.col(tree).alias("of_tree"),
        F.col("task").alias("of_task"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("least")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    return (
        dealt.join(
            starts,
            F.col(tree).eqNullSafe(F.col("of_tree")) & (F.col("task") == F.col("of_task")),
        )
        .withColumn("place", F.col("row") + F.col("shift"))
        .drop("row", "task", "of_tree", "of_task", "shift")
    )


def joined(cells: Sequence[str]) -> str:
    return f"concat_ws('', {', '.join(cells)})" if cells else "''"


class Pivot:
    """A pass over some levels: groups of `width` neighbouring nodes, one row and column per slot."""

    def __init__(self, nodes: DataFrame, fanout: int, levels: int, first: int, payload: list[str]):
        self.fanout, self.levels, self.first = fanout, levels, first
        self.width, self.payload = fanout**levels, payload
        node = f"struct({', '.join(['digest', *payload])})"
        spread = nodes.groupBy("tree", "n", F.expr(f"place div {self.width}").alias("group")).agg(
            *(
                F.expr(f"max(IF(place % {self.width} = {j}, {node}, NULL))").alias(f"slot{j}")
                for j in range(self.width)
            )
        )
        # With the digests of every level in the group, cell<level>_<place>; the top is the last.
        spread = spread.selectExpr("*", *(f"slot{j}.digest AS cell0_{j}" for j in range(self.width)))
        for level in range(levels):
            spread = spread.selectExpr(
                "*", *(self.parent(level, j) for j in range(fanout ** (levels - level - 1)))
            )
        self.rows = durable(spread)

    def open(self, level: int) -> str:
        """Does the tree still have several nodes there?"""
        return f"n > {self.fanout ** (self.first + level)}"

    def run(self, level: int, place: int) -> list[str]:
        return [f"cell{level}_{place * self.fanout + i}" for i in range(self.fanout)]

    def parent(self, level: int, place: int) -> str:
        run = self.run(level, place)
        return (
            f"CASE WHEN {run[0]} IS NULL OR NOT {self.open(level)} THEN {run[0]}"
            f" ELSE sha2({joined(run)}, 256) END AS cell{level + 1}_{place}"
        )

    def tops(self) -> DataFrame:
        """The nodes of the level above the pass."""
        return self.rows.selectExpr(
            "tree", "n", "`group` AS place", f"cell{self.levels}_0 AS digest"
        )

    def path(self, slot: int) -> str:
        """The siblings of a slot from below: for each level those on the left, and on the right."""
        steps = []
        for level in range(self.levels):
            place = slot // self.fanout**level
            run, own = self.run(level, place // self.fanout), place % self.fanout
            left, right = joined(run[:own]), joined(run[own + 1 :])
            steps.append(
                f"IF({self.open(level)}, named_struct('left', {left}, 'right', {right}), NULL)"
            )
        return f"filter(array({', '.join(steps)}), s -> s IS NOT NULL)"

    def spread(self, above: DataFrame) -> DataFrame:
        """The nodes below, each with its path to the root; `above` has those of the groups."""
        over = above.select(
            F.col("tree").alias("of_tree"), F.col("place").alias("of_place"), "subroot", "root",
            F.col("path").alias("up"),
        )
        slots = ", ".join(
            f"IF(slot{j} IS NULL, NULL, named_struct('place', `group` * {self.width} + {j},"
            f" 'node', slot{j}, 'path', {self.path(j)}))"
            for j in range(self.width)
        )
        return (
            self.rows.selectExpr("tree", "group", f"filter(array({slots}), s -> s IS NOT NULL) AS slots")
            .join(
                over,
                F.col("tree").eqNullSafe(F.col("of_tree")) & (F.col("group") == F.col("of_place")),
            )
            # Never empty; the outer form has no filter that repeats the slots.
            .select("tree", "subroot", "root", "up", F.explode_outer("slots").alias("s"))
            .select(
                "tree", "subroot", "root", F.col("s.place").alias("place"),
                *(F.col(f"s.node.{c}").alias(c) for c in ("digest", *self.payload)),
                F.concat("s.path", "up").alias("path"),
            )
        )


def passes(nodes: DataFrame, fanout: int, payload: list[str]) -> list[Pivot]:
    """All levels of the trees, some at a time; each pass leaves a fraction of the nodes."""
    levels = 1
    while fanout ** (levels + 1) <= SLOTS:
        levels += 1
    # One number: the size of the largest tree.
    largest = nodes.agg(F.max("n")).first()[0] or 1
    done = [Pivot(nodes, fanout, levels, 0, payload)]
    while fanout ** (levels * len(done)) < largest:
        done.append(Pivot(done[-1].tops(), fanout, levels, levels * len(done), []))
    return done


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    tree: str = "lang",
    order: str = "doc_id",
    fanout: int = 2,
    claims: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per document: `order`, leaf, claim, subroot, root and path.

    leaf is the digest of the fields in their order, each `spelled`. The leaves of each value of
    `tree` ascend by `order`; every `fanout` neighbours (the last ones of a level may be fewer) become
    the digest of their digests until one node is left, the subroot; the subroots, ascending by
    `tree`, become the root likewise. path lists, from the leaf up to the root, the digests of the
    siblings on the left and on the right as text. claim is the leaf of the row with the values of
    `claims` in place of its own, missing where it is the same.

    Missing values come first and are `-` in a leaf; rows of one tree that share `order` ascend by
    leaf, so repeated rows have leaves of their own with the same digest. A tree of one row is its
    own subroot, a table of one tree has that tree's subroot as root. The empty table gives no rows.
    Other columns are not read. Long texts are only hashed, never moved.
    """
    if fanout < 2:
        raise ValueError(f"fanout must be 2 or more, not {fanout}")
    own = digest(*(spelled(F.col(f)) for f in fields))
    changed = [
        (F.col(f), claims[f].cast("string")) for f in fields if claims is not None and f in claims
    ]
    differs = F.lit(False)
    for was, now in changed:
        differs |= ~was.cast("string").eqNullSafe(now)
    other = digest(*(spelled((claims or {}).get(f, F.col(f))) for f in fields))
    leaves = durable(
        docs.select(
            F.col(tree).alias("tree"), F.col(order).alias("key"), own.alias("digest"),
            F.when(differs, other).alias("claim"),
        )
    )
    steps = passes(numbered(leaves, "tree", ["key", "digest"]), fanout, ["key", "claim"])
    # Trees as the leaves of one more tree, whose own root is the table's.
    subroots = durable(
        numbered(
            steps[-1].tops().select(F.lit(0).alias("tree"), F.col("tree").alias("name"), "digest"),
            "tree", ["name"],
        )
    )
    upper = passes(subroots, fanout, ["name"])
    top = upper[-1].tops()
    above = top.select(
        "tree", "place", F.lit("").alias("subroot"), F.col("digest").alias("root"),
        F.array().cast("array<struct<left:string,right:string>>").alias("path"),
    )
    for step in reversed(upper):
        above = step.spread(above)
    above = above.select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"),
        F.col("digest").alias("subroot"), "root", "path",
    )
    for step in reversed(steps):
        above = step.spread(above)
    return above.select(
        F.col("key").alias(order), F.col("digest").alias("leaf"), "claim", "subroot", "root", "path"
    )


def proof(path: str = "path") -> Column:
    """The digest of all siblings of a path."""
    return digest(F.transform(path, lambda s: F.concat(s["left"], s["right"])))


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(
        F.col(path), leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256)
    )
