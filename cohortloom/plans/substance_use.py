"""Substance use registry: latest diagnosis per substance and latest treatment orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.demographics import demographics
from ..operators.diagnoses import diagnosis_marks
from ..operators.encounters import latest_encounter
from ..operators.events import as_dates, last_per_key, stack_marks
from ..operators.treatments import drug_order_marks, emergency_order_marks
from ..rules.diagnosis_rules import SUBSTANCE_RULES
from ..rules.keywords import BUPRENORPHINE_CODES

BUPRENORPHINE, NALOXONE = "BUP_ORDER_DATE", "NALOXONE_ORDER_DATE"
PERSON = ("AGE_YRS", "SEX", "RACETH")
DATES = (*(r.column for r in SUBSTANCE_RULES), BUPRENORPHINE, NALOXONE)


def seen_patients(
    patients: DataFrame, encounters: DataFrame, as_of=None, ignore_case: bool = False
) -> DataFrame:
    """One row per patient with at least one completed visit or admission: demographics and
    the latest such encounter.  Patients without one are left out."""
    people = demographics(patients, as_of, "AGE_YRS", ignore_case).select("PAT_ID", *PERSON)
    # A patient listed more than once gets the largest value of each column.
    people = people.groupBy("PAT_ID").agg(*(F.max(c).alias(c) for c in PERSON))
    return people.join(latest_encounter(encounters, ignore_case), "PAT_ID", "inner").select(
        "PAT_ID",
        *PERSON,
        F.col("CONTACT_DATE").cast("date").alias("RECENT_CONTACT_DATE"),
        "ENC_TYPE_NM",
        "DEPARTMENT_NAME",
    )


def substance_use_registry(
    patients: DataFrame,
    encounters: DataFrame,
    diagnoses: DataFrame,
    medications: DataFrame,
    as_of=None,
    ignore_case: bool = False,
) -> DataFrame:
    """One row per seen patient with the latest date of each diagnosis and order."""
    evidence = last_per_key(
        stack_marks(
            [
                diagnosis_marks(diagnoses, ignore_case=ignore_case),
                drug_order_marks(medications, BUPRENORPHINE_CODES, BUPRENORPHINE, ignore_case),
                emergency_order_marks(
                    medications, encounters, out=NALOXONE, ignore_case=ignore_case
                ),
            ]
        )
    )
    return seen_patients(patients, encounters, as_of, ignore_case).join(
        as_dates(evidence, DATES), "PAT_ID", "left"
    )
