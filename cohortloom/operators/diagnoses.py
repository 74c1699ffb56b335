"""Latest diagnosis date per substance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import any_word
from ..rules.diagnosis_rules import SUBSTANCE_RULES, DiagnosisRule
from .events import as_dates, last_per_key, mark_events


def diagnosis_condition(rule: DiagnosisRule, ignore_case: bool = False) -> Column:
    name = F.col("DX_NAME")
    tests = []
    if rule.code is not None:
        tests.append(any_word(F.col("CURRENT_ICD10_LIST"), [rule.code], ignore_case))
    if rule.names:
        tests.append(any_word(name, rule.names, ignore_case))
    wanted = reduce(or_, tests)
    if rule.excluded:
        # NULL for an unknown name: such a row dates nothing.
        wanted = wanted & ~any_word(name, rule.excluded, ignore_case)
    return wanted


def diagnosis_marks(
    diagnoses: DataFrame,
    rules: Sequence[DiagnosisRule] = SUBSTANCE_RULES,
    ignore_case: bool = False,
) -> DataFrame:
    """PAT_ID and contact time under each substance the row is a diagnosis of.

    Rows that hold none of the codes and names are left out; a row that holds one but is
    excluded by another may stay, unmarked.
    """
    codes = [r.code for r in rules if r.code is not None]
    names = sorted({n for r in rules for n in r.names})
    related = [
        any_word(F.col(column), words, ignore_case)
        for column, words in (("CURRENT_ICD10_LIST", codes), ("DX_NAME", names))
        if words
    ]
    when = F.col("CONTACT_DATE")
    return mark_events(
        diagnoses.filter(reduce(or_, related)),
        {r.column: (diagnosis_condition(r, ignore_case), when) for r in rules},
        drop_unmarked=False,
    )


def diagnosis_dates(
    diagnoses: DataFrame,
    rules: Sequence[DiagnosisRule] = SUBSTANCE_RULES,
    ignore_case: bool = False,
) -> DataFrame:
    """One row per patient with a dated diagnosis, one date per substance."""
    dates = [r.column for r in rules]
    latest = last_per_key(diagnosis_marks(diagnoses, rules, ignore_case))
    return as_dates(latest.filter(F.coalesce(*dates).isNotNull()), dates)
