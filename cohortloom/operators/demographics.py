"""Age, sex and race-ethnicity of patients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import any_word, equal
from ..functions.scalars import UNKNOWN, as_of_date, unknown_if_null, year_difference
from ..rules.keywords import (
    BLACK, HISPANIC, HISPANIC_GROUP, NH_BLACK, NH_OTHER, NH_WHITE, OTHER_RACES, WHITE,
)


def race_ethnicity(race: Column, ethnicity: Column, ignore_case: bool = False) -> Column:
    """One combined label; the first line that applies decides."""
    white = any_word(race, [WHITE], ignore_case)
    return (
        F.when(equal(HISPANIC_GROUP).on(ethnicity, ignore_case), HISPANIC)
        .when(any_word(race, [BLACK], ignore_case), NH_BLACK)
        .when(any_word(race, OTHER_RACES, ignore_case) & ~white, NH_OTHER)
        .when(white, NH_WHITE)
        .otherwise(UNKNOWN)
    )


def demographics(
    patients: DataFrame, as_of=None, age_col: str = "AGE", ignore_case: bool = False
) -> DataFrame:
    """The patients with age (in calendar years), SEX and RACETH added."""
    return patients.withColumns(
        {
            age_col: year_difference(F.col("BIRTH_DATE"), as_of_date(as_of)),
            "SEX": unknown_if_null(F.col("PAT_SEX")),
            "RACETH": race_ethnicity(
                F.col("PATIENT_RACE"), F.col("ETHNIC_GROUP_NM"), ignore_case
            ),
        }
    )
