"""Medication orders: treatment starts, order flags and latest orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import any_word, equal, is_one_of, or_null
from ..functions.scalars import earlier_of
from ..rules.keywords import (
    ARV_SUBCLASS, CANCELED, EMERGENCY_LOCATION, HEPATITIS_B_CLASS, NALOXONE_CODES, PREP_CODES,
)
from .encounters import emergency_encounters
from .events import first_per_key, last_per_key, mark_events


def treatment_marks(
    meds: DataFrame, name_col: str, drugs: Sequence[str], out: str, ignore_case: bool = False
) -> DataFrame:
    """PAT_ID and start of each order whose name holds one of the drugs."""
    start = earlier_of(F.col("START_DATE"), F.col("ORDERING_DATE"))
    return mark_events(meds, {out: (any_word(F.col(name_col), drugs, ignore_case), start)})


def first_treatment(
    meds: DataFrame, name_col: str, drugs: Sequence[str], out: str, ignore_case: bool = False
) -> DataFrame:
    """First treatment start per patient (NULL where every start is unknown)."""
    return first_per_key(treatment_marks(meds, name_col, drugs, out, ignore_case))


def arv_order_marks(meds: DataFrame, ignore_case: bool = False) -> DataFrame:
    """PAT_ID, ARV_ORDERED = 1 for antiretroviral orders that treat HIV.

    Not cancelled, not a hepatitis B drug (both tests keep NULL), and not a drug used for
    prevention (this one drops NULL codes).
    """
    status, drug_class = F.col("ORDER_STATUS_NM"), F.col("PHARM_CLASS_LIST")
    wanted = (
        or_null(~equal(CANCELED).on(status, ignore_case), status)
        & F.upper("PHARM_SBCLS_LIST").contains(ARV_SUBCLASS)
        & or_null(~equal(HEPATITIS_B_CLASS).on(drug_class, ignore_case), drug_class)
        & ~is_one_of(F.col("ATC_CODE"), PREP_CODES, ignore_case)
    )
    return mark_events(meds, {"ARV_ORDERED": (wanted, F.lit(1))})


def arv_orders(meds: DataFrame, ignore_case: bool = False) -> DataFrame:
    """One row per patient with such an order."""
    return last_per_key(arv_order_marks(meds, ignore_case))


def drug_order_marks(
    meds: DataFrame, atc_codes: Sequence[str], out: str, ignore_case: bool = False
) -> DataFrame:
    wanted = is_one_of(F.col("ATC_CODE"), atc_codes, ignore_case)
    return mark_events(meds, {out: (wanted, F.col("ORDERING_DATE"))})


def latest_drug_order(
    meds: DataFrame, atc_codes: Sequence[str], out: str, ignore_case: bool = False
) -> DataFrame:
    """Time of the latest order of one of the drugs per patient."""
    return last_per_key(drug_order_marks(meds, atc_codes, out, ignore_case))


def emergency_order_marks(
    meds: DataFrame,
    encounters: DataFrame,
    atc_codes: Sequence[str] = NALOXONE_CODES,
    location: str = EMERGENCY_LOCATION,
    out: str = "NALOXONE_ORDER_DATE",
    ignore_case: bool = False,
) -> DataFrame:
    """Latest order time per emergency encounter.

    The order was placed in, or the patient was in, the emergency department, and the
    encounter started there.  Orders are reduced to one row per encounter before the join.
    """
    here = equal(location)
    visit = ["PAT_ID", "PAT_ENC_CSN_ID"]
    orders = (
        meds.filter(is_one_of(F.col("ATC_CODE"), atc_codes, ignore_case))
        .filter(
            here.on(F.col("ORDERING_PROV_LOGIN_LOC"), ignore_case)
            | here.on(F.col("PAT_LOC_AT_ORDER"), ignore_case)
        )
        .groupBy(*visit)
        .agg(F.max("ORDERING_DATE").alias(out))
    )
    visits = emergency_encounters(encounters).select(*visit).distinct()
    return orders.join(visits, visit, "left_semi").select("PAT_ID", out)


def emergency_orders(meds: DataFrame, encounters: DataFrame, **options) -> DataFrame:
    """Time of the latest such order per patient."""
    return last_per_key(emergency_order_marks(meds, encounters, **options))
