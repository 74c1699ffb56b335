"""Removal of repeated runs of lines, by overlapping windows of three."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.skew import lookup_join

from .common import durable, fingerprint

WINDOW = 3


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """(doc_id, text_key, covered): the lines of each document to remove, as indexes from 0.

    See `without_repeats` for what they are.
    """
    solid = F.filter(
        F.transform(
            _lines(text), lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(" \t\r")).alias("x"))
        ),
        lambda s: s["x"] != "",
    )
    found = (
        docs.select(
            F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), solid.alias("lines")
        )
        .filter(F.size("lines") > 0)
        .select(
            "doc_id",
            "text_key",
            F.explode(
                F.transform(
                    F.sequence(
                        F.lit(1), F.greatest(F.size("lines") - F.lit(window - 1), F.lit(1))
                    ),
                    lambda i: F.slice(F.col("lines"), i, F.lit(window)),
                )
            ).alias("w"),
        )
        .select(
            "doc_id",
            "text_key",
            F.col("w.i").alias("covered"),
            fingerprint(F.col("w.x"), salt=1).alias("h1"),
            fingerprint(F.col("w.x"), salt=2).alias("h2"),
        )
    )
    found = durable(found)
    place = F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", F.col("covered")[0].alias("at")
    )
    often = (
        found.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    # A window that a third of all texts share is one key: the join can split it.
    return (
        lookup_join(found.withColumn("place", place), often, ["h1", "h2"], "inner")
        .filter("place <> first")
        .groupBy("doc_id", "text_key")
        .agg(F.array_distinct(F.flatten(F.collect_set("covered"))).alias("covered"))
    )


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """(doc_id, n_lines, n_removed, text): the texts without what stood before in the corpus.

    Lines end at \\n. Blanks, tabs and returns around a line are not compared, lines without
    anything else are passed over. Every run of `window` such lines is a window, a text with fewer
    is one window. The first place of a window is that with the smallest doc_id (a missing one is
    last), then text hash, then line; at all later places its lines go, overlapping windows
    together. Everything else stays as it is. Rows that repeat with doc_id and text count once and
    fare alike. A missing text stays missing and has no lines. The empty table gives none.
    """
    gone = repeated_lines(docs, doc_id, text, window).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k1"),
        F.col("doc_id").isNull().alias("k2"),
        F.col("text_key").alias("k3"),
        "covered",
    )
    lines = F.col("lines")
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered")), lambda i: lines[i]
    )
    return (
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(text).alias("text"),
            F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("k1"),
            F.col(doc_id).isNull().alias("k2"),
            F.xxhash64(F.col(text)).alias("k3"),
        )
        .join(gone, ["k1", "k2", "k3"], "left")
        .withColumn("lines", _lines("text"))
        .select(
            "doc_id",
            F.when(F.col("text").isNull(), 0)
            .otherwise(F.size(lines))
            .cast("long")
            .alias("n_lines"),
            F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
            F.when(F.col("covered").isNull(), F.col("text"))
            .otherwise(F.array_join(kept, "\n"))
            .alias("text"),
        )
    )
