"""Hepatitis C registry: patients with any evidence of infection or treatment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.events import first_events, first_per_key, mark_events, stack_marks
from ..operators.results import hepatitis_results
from ..operators.treatments import treatment_marks
from ..rules.keywords import HEPATITIS_BRANDS, HEPATITIS_DRUGS
from ..rules.result_rules import POSITIVE

LAB_EVIDENCE = {
    "FIRST_REACTIVE_DATE": "AB",
    "FIRST_DETECTED_DATE": "RNA",
    "FIRST_GENOTYPE_DATE": "Genotype",
}
ORDERED, ACTIVE = "FIRST_TRT_ORDER_DATE", "FIRST_TRT_ACTIVE_DATE"
ELIGIBLE = "HCV_REGISTRY_ELIGIBLE"


def lab_evidence_marks(results: DataFrame) -> DataFrame:
    """Result time of each positive result under its kind of evidence.

    Negative results stay as unmarked rows.  They cost one row per patient and task in the
    shuffle, whereas a filter on the label is pushed below the columns the label is made of
    and then repeats their expressions in every rule.
    """
    return mark_events(
        results,
        {n: (cond, F.col("RESULT_TIME")) for n, cond in lab_evidence_conditions().items()},
        drop_unmarked=False,
    )


def lab_evidence_conditions() -> dict:
    """Which classified result is evidence of which kind."""
    positive = F.col("TEST_RESULT") == POSITIVE
    return {name: (F.col("TEST_TYPE") == kind) & positive for name, kind in LAB_EVIDENCE.items()}


def first_lab_evidence(results: DataFrame) -> DataFrame:
    """First positive antibody, RNA and genotype result per patient with a positive result."""
    return first_events(results, lab_evidence_conditions(), "RESULT_TIME", filter_rows=False)


def hepatitis_registry(
    patients: DataFrame,
    labs: DataFrame | None = None,
    medications: DataFrame | None = None,
    active_medications: DataFrame | None = None,
    results: DataFrame | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """One row per patient row: first date of each kind of evidence, and eligibility.

    A patient is eligible with at least one *dated* piece of evidence.  ``results`` takes
    already classified results in place of ``labs``; either medication table may be left out, its
    date is then NULL.
    """
    if results is None:
        if labs is None:
            raise ValueError("either labs or results must be given")
        results = hepatitis_results(labs, ignore_case=ignore_case)
    marks = [lab_evidence_marks(results)]
    absent = []
    if medications is not None:
        marks.append(
            treatment_marks(medications, "ATC_TITLE", HEPATITIS_DRUGS, ORDERED, ignore_case)
        )
    else:
        absent.append(ORDERED)
    if active_medications is not None:
        names = HEPATITIS_DRUGS + HEPATITIS_BRANDS
        marks.append(
            treatment_marks(active_medications, "MEDICATION_NAME", names, ACTIVE, ignore_case)
        )
    else:
        absent.append(ACTIVE)
    evidence = first_per_key(stack_marks(marks)).withColumns(
        {name: F.lit(None).cast("timestamp_ntz") for name in absent}
    )
    dates = [*LAB_EVIDENCE, ORDERED, ACTIVE]
    # Patients stand in about one row each: no key to split, so the aggregate's spread serves.
    return patients.select("PAT_ID").join(evidence, "PAT_ID", "left").select(
        "PAT_ID",
        *dates,
        F.coalesce(*dates).isNotNull().cast("int").alias(ELIGIBLE),
    )


def registry_summary(registry: DataFrame) -> DataFrame:
    """One row: patients in the registry and how many are eligible."""
    return registry.agg(
        F.countDistinct("PAT_ID").alias("IN_REGISTRY"), F.sum(ELIGIBLE).alias("ELIGIBLE")
    )
