"""HIV registry: evidence of infection, monitored, and engaged in care."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_of_date, day_difference, zero_if_null
from ..operators.comments import positive_comment_orders
from ..operators.demographics import demographics
from ..operators.encounters import ENGAGED, SEEN, encounter_marks
from ..operators.events import (
    as_dates, last_events, last_per_key, mark_events, presence_flags, stack_marks,
)
from ..operators.results import hiv_results
from ..operators.treatments import arv_order_marks
from ..rules.keywords import EXCLUDED, IN_REGISTRY
from ..rules.result_rules import POSITIVE

CD4_TYPES = ("CD4 Absolute", "CD4 Percentage")
RNA_DATE, CD4_DATE = "RNA_RECENT_DATE", "CD4_RECENT_DATE"
FLAGS = (
    "AB_TESTED", "AB_REACTIVE", "AB_DIFF_TESTED", "AB_DIFF_REACTIVE", "AB_CONF_REACTIVE",
    "RNA_TESTED", "RNA_DETECTED", "CD4_TESTED", "ARV_ORDERED",
)
REGISTRY_COLUMNS = (
    "PAT_ID", "PAT_MRN_ID", "AGE", "SEX", "RACE_PRIMARY", "HISPANIC_YN", "RACETH",
    "AB_TESTED", "AB_REACTIVE", "AB_DIFF_TESTED", "AB_DIFF_REACTIVE", "AB_CONF_REACTIVE",
    "RNA_TESTED", RNA_DATE, "DAYS_SINCE_RNA", "RNA_DETECTED",
    "CD4_TESTED", CD4_DATE, "DAYS_SINCE_CD4", "ARV_ORDERED", SEEN, ENGAGED, "HIVCOR",
)


def lab_flag_conditions() -> dict:
    """What each laboratory flag means on a classified result."""
    kind, positive = F.col("TEST_TYPE"), F.col("TEST_RESULT") == POSITIVE
    return {
        "AB_TESTED": kind == "AB",
        "AB_REACTIVE": (kind == "AB") & positive,
        "AB_DIFF_TESTED": kind == "Differentiation",
        "AB_DIFF_REACTIVE": (kind == "Differentiation") & positive,
        "AB_CONF_REACTIVE": (kind == "Confirmatory") & positive,
        "RNA_TESTED": kind == "RNA",
        "RNA_DETECTED": (kind == "RNA") & positive,
        "CD4_TESTED": kind.isin(*CD4_TYPES),
    }


def last_test_conditions() -> dict:
    kind = F.col("TEST_TYPE")
    return {RNA_DATE: kind == "RNA", CD4_DATE: kind.isin(*CD4_TYPES)}


def last_test_dates(results: DataFrame) -> DataFrame:
    """Date of the latest viral load and CD4 order per patient."""
    return last_events(results, last_test_conditions(), "ORDER_INST", filter_rows=False)


def lab_flags(results: DataFrame) -> DataFrame:
    """The flags of every patient with any, NULL for those that do not apply."""
    return presence_flags(results, lab_flag_conditions(), filter_rows=False)


def lab_marks(results: DataFrame) -> DataFrame:
    """All flags and test times of a result in one row."""
    marks = {n: (cond, F.lit(1)) for n, cond in lab_flag_conditions().items()}
    marks |= {n: (cond, F.col("ORDER_INST")) for n, cond in last_test_conditions().items()}
    return mark_events(results, marks, drop_unmarked=False)


def reactive_differentiation(comment_lines: DataFrame, results: DataFrame) -> DataFrame:
    """Patients with a reactive differentiation test, by comment text or by result."""
    by_comment = positive_comment_orders(comment_lines, results).select(
        "PAT_ID", F.lit(1).alias("AB_DIFF_REACTIVE")
    )
    reactive = lab_flag_conditions()["AB_DIFF_REACTIVE"]
    by_result = mark_events(
        results, {"AB_DIFF_REACTIVE": (reactive, F.lit(1))}, drop_unmarked=False
    )
    found = last_per_key(stack_marks([by_comment, by_result]))
    return found.filter(F.col("AB_DIFF_REACTIVE").isNotNull())


def hiv_registry(
    patients: DataFrame,
    labs: DataFrame | None = None,
    comment_lines: DataFrame | None = None,
    medications: DataFrame | None = None,
    encounters: DataFrame | None = None,
    as_of=None,
    results: DataFrame | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """One row per patient row: demographics, test flags, recency, care, and the label.

    Results, comments, orders and encounters are marked row by row and reduced per patient
    by one aggregate, then joined to the patients once.  ``results`` takes already classified
    results in place of ``labs``.  Without comments, medications or encounters, what only they tell
    is 0 or NULL; the columns stay.
    """
    if results is None:
        if labs is None:
            raise ValueError("either labs or results must be given")
        results = hiv_results(labs, ignore_case=ignore_case)
    marks = [lab_marks(results)]
    absent = {}
    if comment_lines is not None:
        orders = positive_comment_orders(comment_lines, results)
        marks.append(orders.select("PAT_ID", F.lit(1).alias("AB_DIFF_REACTIVE")))
    if medications is not None:
        marks.append(arv_order_marks(medications, ignore_case))
    else:
        absent["ARV_ORDERED"] = F.lit(None).cast("int")
    if encounters is not None:
        marks.append(encounter_marks(encounters, ignore_case=ignore_case))
    else:
        absent |= dict.fromkeys((SEEN, ENGAGED), F.lit(None).cast("timestamp_ntz"))
    evidence = last_per_key(stack_marks(marks)).withColumns(absent)
    evidence = as_dates(evidence, (RNA_DATE, CD4_DATE, SEEN, ENGAGED))

    known = patients.select(
        "PAT_ID", "PAT_MRN_ID", "BIRTH_DATE", "PAT_SEX", "PATIENT_RACE", "ETHNIC_GROUP_NM"
    )
    today = as_of_date(as_of)
    rows = demographics(
        known.join(evidence, "PAT_ID", "left"), as_of, ignore_case=ignore_case
    )
    rows = rows.withColumns({f: zero_if_null(F.col(f)) for f in FLAGS}).withColumns(
        {
            "RACE_PRIMARY": F.col("PATIENT_RACE"),
            "HISPANIC_YN": F.col("ETHNIC_GROUP_NM"),
            "DAYS_SINCE_RNA": day_difference(F.col(RNA_DATE), today),
            "DAYS_SINCE_CD4": day_difference(F.col(CD4_DATE), today),
            "HIVCOR": registry_label(),
        }
    )
    return rows.select(*REGISTRY_COLUMNS)


def registry_label():
    """In the registry with evidence, monitoring and care; screening tests do not count."""

    def any_flag(*names: str):
        return F.greatest(*names) == 1

    evidence = any_flag("AB_DIFF_REACTIVE", "AB_CONF_REACTIVE", "RNA_DETECTED", "ARV_ORDERED")
    monitored = any_flag("RNA_TESTED", "CD4_TESTED")
    engaged = F.col(ENGAGED).isNotNull()
    return F.when(evidence & monitored & engaged, IN_REGISTRY).otherwise(EXCLUDED)
