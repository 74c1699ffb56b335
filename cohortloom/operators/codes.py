"""Code-set categorisation: give each row the type its code belongs to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CodeSets = Mapping[str, Sequence[int]]


def code_table(
    spark: SparkSession,
    code_sets: CodeSets,
    code_col: str = "COMPONENT_ID",
    type_col: str = "TEST_TYPE",
) -> DataFrame:
    """The code sets as a small table, one row per code."""
    check_disjoint(code_sets)
    rows = [(int(c), t) for t, codes in code_sets.items() for c in codes]
    entries = F.array(*(F.struct(F.lit(c).alias("c"), F.lit(t).alias("t")) for c, t in rows))
    return (
        spark.range(1)
        .select(F.explode(entries).alias("entry"))
        .select(F.col("entry.c").alias(code_col), F.col("entry.t").alias(type_col))
    )


def check_disjoint(code_sets: CodeSets) -> None:
    """ValueError if a code stands in two sets: it would have two types."""
    seen: dict[int, str] = {}
    for name, codes in code_sets.items():
        for code in codes:
            if seen.setdefault(int(code), name) != name:
                raise ValueError(f"code {code} is in {seen[int(code)]!r} and in {name!r}")


def type_of(code: Column, code_sets: CodeSets) -> Column:
    """Type of a code, NULL for an unknown one."""
    first, *rest = code_sets.items()
    label = F.when(code.isin(*first[1]), first[0])
    for name, codes in rest:
        label = label.when(code.isin(*codes), name)
    return label


def tag_codes(
    df: DataFrame,
    code_sets: CodeSets,
    code_col: str = "COMPONENT_ID",
    type_col: str = "TEST_TYPE",
) -> DataFrame:
    """Keep rows with a known code and add its type.

    The sets are literals, so the filter reaches the parquet scan and no join is planned.
    """
    check_disjoint(code_sets)
    known = sorted(chain.from_iterable(code_sets.values()))
    return df.filter(F.col(code_col).isin(*known)).withColumn(
        type_col, type_of(F.col(code_col), code_sets)
    )


def join_code_table(df: DataFrame, codes: DataFrame, code_col: str = "COMPONENT_ID") -> DataFrame:
    """As :func:`tag_codes`, the sets coming as a table with one row per code.

    No broadcast is forced: the table's own size decides, and a table too large to
    broadcast is shuffled, both sides plainly enough for adaptive skew splitting.
    """
    return df.join(codes, code_col, "inner")
