"""From raw laboratory rows to typed, numeric and classified results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import any_word, equal, or_null
from ..functions.scalars import strip_symbols, to_double, to_int
from ..rules.code_sets import HEPATITIS_CODES, HIV_CODES
from ..rules.result_rules import (
    COMMENT, COMPLETED, HEPATITIS_RULES, HIV_RULES, STRIPPED, UNUSABLE_MARKS, VALUE, ResultRule,
)
from ..sources.tables import materialise
from .codes import CodeSets, tag_codes
from .comments import comment_presence
from .skew import lookup_join

ORDER_COLUMNS = ("PAT_ID", "ORDER_PROC_ID", "ORDER_INST", "SPECIMN_TAKEN_TIME", "RESULT_TIME")
HEPATITIS_RESULT_COLUMNS = (
    *ORDER_COLUMNS, "COMPONENT_ID", VALUE, COMMENT, "TEST_TYPE", "RNA_VALUE", "TEST_RESULT",
)
HIV_RESULT_COLUMNS = (
    *ORDER_COLUMNS, "COMPONENT_ID", VALUE, COMMENT, STRIPPED, "TEST_TYPE", "RNA_VALUE",
    "TEST_RESULT",
)


def usable_results(
    labs: DataFrame, keep_null: bool = False, ignore_case: bool = False
) -> DataFrame:
    """Completed orders whose value is not marked unusable.

    A row without a value is dropped, or kept with ``keep_null`` (its comment may still tell).
    """
    value = F.col(VALUE)
    usable = ~any_word(value, UNUSABLE_MARKS, ignore_case)
    if keep_null:
        usable = or_null(usable, value)
    return labs.filter(equal(COMPLETED).on(F.col("ORDER_STATUS_NM"), ignore_case)).filter(usable)


def numeric_result(kind: str, test_type: Column, stripped: Column) -> Column:
    """Viral load as ``double`` or ``int``; NULL for other tests and for text."""
    number = {"double": to_double, "int": to_int}[kind](stripped)
    return F.when(test_type == "RNA", number)


def classify(rules: Sequence[ResultRule], ignore_case: bool = False) -> Column:
    """Label of the first rule that matches, NULL if none does."""
    if not rules:
        return F.lit(None).cast("string")
    label = F
    for rule in rules:
        match = rule.pattern.on(F.col(rule.column), ignore_case)
        if rule.test_type is not None:
            match = (F.col("TEST_TYPE") == rule.test_type) & match
        label = label.when(match, rule.label)
    return label


def hepatitis_results(
    labs: DataFrame,
    code_sets: CodeSets = HEPATITIS_CODES,
    extra: Sequence[str] = (),
    ignore_case: bool = False,
) -> DataFrame:
    """Classified hepatitis C results; text comes out upper-cased.

    ``extra`` names further laboratory columns to carry along.
    """
    # The unusable marks are searched before, the rules after upper-casing.
    rows = tag_codes(usable_results(labs, ignore_case=ignore_case), code_sets)
    rows = rows.withColumns(
        {
            STRIPPED: strip_symbols(F.col(VALUE)),
            VALUE: F.upper(VALUE),
            COMMENT: F.upper(COMMENT),
        }
    )
    return rows.withColumns(
        {
            "RNA_VALUE": numeric_result("double", F.col("TEST_TYPE"), F.col(STRIPPED)),
            "TEST_RESULT": classify(HEPATITIS_RULES, ignore_case),
        }
    ).select(*HEPATITIS_RESULT_COLUMNS, *extra)


def hiv_results(
    labs: DataFrame,
    comment_lines: DataFrame | None = None,
    code_sets: CodeSets = HIV_CODES,
    extra: Sequence[str] = (),
    ignore_case: bool = False,
) -> DataFrame:
    """Classified HIV results; text stays as entered.

    With ``comment_lines`` the column HAS_COMMENT tells whether the order has long comments
    (1, else NULL).
    """
    rows = tag_codes(usable_results(labs, keep_null=True, ignore_case=ignore_case), code_sets)
    rows = rows.withColumn(STRIPPED, strip_symbols(F.col(VALUE)))
    rows = rows.withColumns(
        {
            "RNA_VALUE": numeric_result("int", F.col("TEST_TYPE"), F.col(STRIPPED)),
            "TEST_RESULT": classify(HIV_RULES, ignore_case),
        }
    )
    if comment_lines is None:
        return rows.select(*HIV_RESULT_COLUMNS, *extra)
    return lookup_join(
        rows, comment_presence(comment_lines), ["ORDER_PROC_ID"], "left"
    ).select(*HIV_RESULT_COLUMNS, "HAS_COMMENT", *extra)


def stored_results(results: DataFrame, path: str) -> DataFrame:
    """Classified results written once, and a scan of them for registries and reports to share.

    The laboratory table is scanned and classified by this write only.  Rows lie by component, so
    that a reader that wants few components skips the other row groups; a component with very many
    results fills several files, by order.
    """
    return materialise(results, path, sort_by=("COMPONENT_ID", "ORDER_PROC_ID"))
