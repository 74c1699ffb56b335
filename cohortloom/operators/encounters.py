"""Encounters: last seen, last engaged in care, latest contact, emergency visits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import any_word, equal, or_null
from ..rules.keywords import CARE_SITES, ERRONEOUS
from ..rules.result_rules import COMPLETED
from .events import as_dates, last_per_key, latest_row, mark_events

SEEN = "LAST_SEEN_DATE"
ENGAGED = "LAST_ENGAGED_DATE"


def encounter_marks(
    encounters: DataFrame, sites: Sequence[str] = CARE_SITES, ignore_case: bool = False
) -> DataFrame:
    """Contact times that count as seen (completed or discharged) and as engaged in care
    (completed, at one of the sites).  Erroneous encounters count as neither."""
    kind, when = F.col("ENC_TYPE_NM"), F.col("CONTACT_DATE")
    completed = equal(COMPLETED).on(F.col("APPT_STATUS_NM"), ignore_case)
    valid = encounters.filter(or_null(~F.upper(kind).contains(ERRONEOUS), kind))
    return mark_events(
        valid,
        {
            SEEN: (completed | F.col("HOSP_DISCH_TIME").isNotNull(), when),
            ENGAGED: (completed & any_word(F.col("DEPARTMENT_NAME"), sites, ignore_case), when),
        },
    )


def last_seen_and_engaged(
    encounters: DataFrame, sites: Sequence[str] = CARE_SITES, ignore_case: bool = False
) -> DataFrame:
    """Last seen and last engaged date per patient."""
    return as_dates(last_per_key(encounter_marks(encounters, sites, ignore_case)), (SEEN, ENGAGED))


def latest_encounter(encounters: DataFrame, ignore_case: bool = False) -> DataFrame:
    """PAT_ID, CONTACT_DATE, ENC_TYPE_NM, DEPARTMENT_NAME of the latest completed visit or
    admission.

    Equal contact times are decided by the higher encounter number, then by type and department.
    """
    counted = encounters.filter(
        equal(COMPLETED).on(F.col("APPT_STATUS_NM"), ignore_case)
        | F.col("HOSP_ADMSN_TIME").isNotNull()
    )
    order = ("CONTACT_DATE", "PAT_ENC_CSN_ID")
    latest = latest_row(counted, order, ("ENC_TYPE_NM", "DEPARTMENT_NAME"))
    return latest.drop("PAT_ENC_CSN_ID")


def emergency_encounters(encounters: DataFrame) -> DataFrame:
    """Encounters whose emergency admission precedes any inpatient or outpatient one."""
    emergency = F.col("EMER_ADM_DATE")
    return encounters.filter(emergency.isNotNull()).filter(
        or_null(F.col("INP_ADM_DATE") > emergency, F.col("INP_ADM_DATE"))
        & or_null(F.col("OP_ADM_DATE") > emergency, F.col("OP_ADM_DATE"))
    )
