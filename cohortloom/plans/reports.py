"""Review reports on the registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import any_word
from ..operators.codes import CodeSets
from ..operators.results import hepatitis_results
from ..operators.skew import lookup_join
from ..rules.keywords import HEPATITIS_COMPONENT_NAMES
from .hepatitis import ELIGIBLE


def result_combinations(labs: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Distinct combinations of component, value, comment and the label they got."""
    return (
        hepatitis_results(labs, extra=["COMPONENT_NM"], ignore_case=ignore_case)
        .select(
            "COMPONENT_ID", "COMPONENT_NM", "TEST_TYPE", "TEST_RESULT", "ORD_VALUE",
            "COMPONENT_COMMENT",
        )
        .distinct()
    )


def unflagged_labs(labs: DataFrame, registry: DataFrame) -> DataFrame:
    """Hepatitis C related laboratory rows of patients who were not flagged."""
    related = labs.filter(any_word(F.upper("COMPONENT_NM"), HEPATITIS_COMPONENT_NAMES))
    unflagged = registry.filter(F.col(ELIGIBLE) == 0).select("PAT_ID")
    return lookup_join(
        related.select(
            "PAT_ID", "PAT_ENC_CSN_ID", "PROC_CODE", "ORDER_DESCRIPTION", "COMPONENT_ID",
            "COMPONENT_NM", "ORD_VALUE", "COMPONENT_COMMENT",
        ),
        unflagged,
        ["PAT_ID"],
        "inner",
    )


def flagged_without_lab(registry: DataFrame) -> DataFrame:
    """Eligible patients with neither a reactive antibody nor a detected RNA result."""
    return registry.filter(
        F.col("FIRST_DETECTED_DATE").isNull()
        & F.col("FIRST_REACTIVE_DATE").isNull()
        & (F.col(ELIGIBLE) == 1)
    )


def component_service(labs: DataFrame, code_sets: CodeSets) -> DataFrame:
    """First and last specimen time per laboratory component of the code sets."""
    codes = sorted(c for group in code_sets.values() for c in group)
    return (
        labs.filter(F.col("COMPONENT_ID").isin(*codes))
        .groupBy("COMPONENT_ID", "COMPONENT_NM")
        .agg(
            F.min("SPECIMN_TAKEN_TIME").alias("min"),
            F.max("SPECIMN_TAKEN_TIME").alias("max"),
        )
    )


def page(df: DataFrame, order_by: Sequence[str], offset: int = 10, size: int = 10) -> DataFrame:
    """Some rows to look at, in order.  ``order_by`` should be unique for a stable page."""
    return df.orderBy(*order_by).offset(offset).limit(size)
