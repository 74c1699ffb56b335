"""Long result comments, stored as numbered lines per order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import any_word
from ..rules.code_sets import COMMENTED_COMPONENTS
from ..rules.result_rules import POSITIVE_COMMENT_MARKS
from .skew import lookup_join

ORDER = "ORDER_PROC_ID"


def comment_presence(lines: DataFrame) -> DataFrame:
    """One row per order with comment lines: ORDER_PROC_ID, HAS_COMMENT = 1."""
    return lines.select(ORDER).distinct().withColumn("HAS_COMMENT", F.lit(1))


def positive_lines(lines: DataFrame, marks: Sequence[str] = POSITIVE_COMMENT_MARKS) -> DataFrame:
    """Comment lines that state a positive result, in any letter case."""
    return lines.filter(any_word(F.upper("RESULTS_CMT"), marks))


def commented_orders(
    results: DataFrame, components: Sequence[int] = COMMENTED_COMPONENTS
) -> DataFrame:
    """Orders with a result of one of the components, and how many such results."""
    return (
        results.filter(F.col("COMPONENT_ID").isin(*components))
        .groupBy(ORDER)
        .agg(F.count(F.lit(1)).alias("__results"))
    )


def positive_comments(
    lines: DataFrame,
    results: DataFrame,
    marks: Sequence[str] = POSITIVE_COMMENT_MARKS,
    components: Sequence[int] = COMMENTED_COMPONENTS,
) -> DataFrame:
    """PAT_ID, ORDER_PROC_ID, COMMENT: an order's positive lines in line order.

    A line counts once per result of its order: with two results it occurs twice, each copy
    next to the other.  The results are counted before the join, so lines are never
    multiplied on their way through the shuffle.  One order's text is one value and is put
    together in one task; only positive lines of matching orders get there.
    """
    matched = lookup_join(
        positive_lines(lines, marks).select("PAT_ID", ORDER, "LINE_COMMENT", "RESULTS_CMT"),
        commented_orders(results, components),
        [ORDER],
        "inner",
    )
    return (
        matched.withColumn(
            "__text",
            F.expr("array_join(array_repeat(RESULTS_CMT, CAST(__results AS INT)), ' ')"),
        )
        .groupBy("PAT_ID", ORDER)
        .agg(
            F.expr(
                "listagg(__text, ' ') WITHIN GROUP (ORDER BY LINE_COMMENT NULLS FIRST, RESULTS_CMT)"
            ).alias("COMMENT")
        )
    )


def positive_comment_orders(
    lines: DataFrame,
    results: DataFrame,
    marks: Sequence[str] = POSITIVE_COMMENT_MARKS,
    components: Sequence[int] = COMMENTED_COMPONENTS,
) -> DataFrame:
    """PAT_ID, ORDER_PROC_ID of the orders above, without their text.

    Both sides are reduced to distinct orders before they meet.
    """
    orders = commented_orders(results, components).select(ORDER)
    positive = positive_lines(lines, marks).select("PAT_ID", ORDER).distinct()
    return positive.join(orders, ORDER, "left_semi").select("PAT_ID", ORDER)
