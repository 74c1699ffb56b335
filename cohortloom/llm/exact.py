"""Exact deduplication by recipes of content-defined chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.skew import lookup_join

from .common import durable, fingerprint, whole_text

#: A chunk ends at the first line or sentence end after LEAST characters, or at MOST.
LEAST, MOST = 512, 4096


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text cut where its content says so; equal texts are cut alike, wherever they stand."""
    pattern = rf"(?s).{{{least},{most - 2}}}?(?:\n|[.!?]\x20)|.{{{most}}}|.+"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def spelled(parts: str) -> Column:
    """An ordered list of chunk identifiers as text."""
    return F.array_join(
        F.transform(
            parts,
            lambda p: F.concat_ws(
                ":", p["h1"].cast("string"), p["h2"].cast("string"), F.coalesce(F.hex(p["text"]), F.lit(""))
            ),
        ),
        ",",
    )


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_sha256, rows, recipe) of each distinct row: the digest of its recipe.

    A recipe is the list of chunk identifiers in their order.

    A chunk's identifier is its 128-bit hash, once all chunks with that hash are seen to hold the
    same characters. Where they do not, the identifier also holds the digest of the characters.
    Only this check moves text, and it moves a chunk once per task, however often it stands there.
    """
    pieces = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.sha2(whole_text(text), 256).alias("text_sha256"),
        F.posexplode_outer(chunks(whole_text(text))).alias("place", "chunk"),
    ).withColumns(
        {"h1": fingerprint(F.col("chunk"), salt=1), "h2": fingerprint(F.col("chunk"), salt=2)}
    )
    mixed = (
        pieces.filter("chunk IS NOT NULL")
        .groupBy("h1", "h2")
        .agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
        .filter("least <> most")
        .select("h1", "h2", F.lit(True).alias("mixed"))
    )
    pieces = pieces.withColumn("digest", F.unhex(F.sha2("chunk", 256))).drop("chunk")
    # A chunk that a third of all texts share is one key: the join can split it.
    return (
        lookup_join(pieces, mixed, ["h1", "h2"])
        .groupBy("doc_id", "text_sha256")
        .agg(
            F.count_if(F.coalesce(F.col("place"), F.lit(0)) == 0).alias("rows"),
            F.array_sort(
                F.collect_set(
                    F.when(
                        F.col("place").isNotNull(),
                        F.struct("place", "h1", "h2", F.when(F.col("mixed"), F.col("digest")).alias("text")),
                    )
                )
            ).alias("parts"),
        )
        .select(
            "doc_id",
            "text_sha256",
            "rows",
            F.unhex(F.sha2(spelled("parts"), 256)).alias("recipe"),
        )
    )


def decisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_sha256, rows, keep_id, group_size, keeps) for each distinct row.

    Texts are equal when identical; a missing one counts as empty. Of equal texts the row with the
    largest doc_id stays, a missing doc_id being below all others; of rows that also share the
    doc_id, one. `keeps` marks the distinct row of which one stays. Any other column is ignored.
    The empty table gives none.
    """
    listed = durable(recipes(docs, doc_id, text))
    groups = listed.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size")
    )
    # Copies that hold a third of all rows are one recipe: the join can split it.
    return lookup_join(listed, groups, ["recipe"], "inner").select(
        "doc_id", "text_sha256", "rows", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("keeps"),
    )


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, dropped ones too: `decisions` with `kept` for each row."""
    return (
        decisions(docs, doc_id, text)
        .withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("keeps") & (F.col("row") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns; see `decisions`.

    Of rows that share doc_id and text, that with the least hash of all its columns stays, so that a
    task that runs again keeps the same. A missing text or doc_id stays missing. The empty table
    gives none.
    """
    keys = ["k1", "k2", "k3"]
    stay = decisions(docs, doc_id, text).filter("keeps").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k1"),
        F.col("doc_id").isNull().alias("k2"),
        F.col("text_sha256").alias("k3"),
    )
    return (
        docs.select(
            F.struct("*").alias("document"),
            F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("k1"),
            F.col(doc_id).isNull().alias("k2"),
            F.sha2(whole_text(text), 256).alias("k3"),
        )
        .join(stay, keys, "left_semi")
        .groupBy(*keys)
        .agg(F.min_by("document", F.xxhash64("document")).alias("document"))
        .select("document.*")
    )
