"""Hospital-shaped views over the TPC-H-like sample tables.

The sample tables hold no clinical text, so every column is worked out from their keys and
dates: integer arithmetic and list lookups only, which any SQL engine can repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules.code_sets import HEPATITIS_CODES, HIV_CODES
from ..rules.keywords import HEPATITIS_BRANDS, HEPATITIS_DRUGS
from .schemas import table_schema
from .tables import read_source

# Fixed values of the views.
NAMED_COMPONENTS = (
    1526626, 1230000019, 784, 1811181, 4338, 1230001113, 2618, 3061, 1230001115, 273,
    1230001172, 2221, 2222, 1257, 268, 1558004, 1510740, 1662, 1558135, 1558134,
)
# All codes of the registries, those above first.
COMPONENTS = tuple(
    dict.fromkeys(
        [*NAMED_COMPONENTS]
        + [c for s in (HEPATITIS_CODES, HIV_CODES) for codes in s.values() for c in codes]
    )
)
OTHER_COMPONENT = 999
COMPONENT_NAMES = (
    "Hepatitis C antibody", "HCV antibody IgG", "HCV RNA qualitative", "HCV RNA PCR",
    "HCV RNA quantitative", "HCV viral load", "HCV high-res genotype", "NS5A genotype",
    "Hcv genotype", "HIV antibody screen", "HIV screen", "HIV differentiation",
    "HIV interpretation", "HIV multispot", "HIV NAAT", "HIV confirmation", "HIV copies",
    "HIV qualitative", "CD4 absolute", "CD4 percent", "Hepatitis c panel", "hcv fibrosis score",
)
VALUES = (
    "NON-REACTIVE", "REACTIVE", "<15 DETECTED", "1a", "NOT DETECTED", "DETECTED", ">1,000",
    "250", "<20", "<30 Detected", "Target Not Detected", "POSITIVE", "NEGATIVE", "INVALID",
    "INDETERMINATE", "TNP", "EQUIVOCAL", "SEE COMMENT", None, "=1.5", "$",
)
COMMENTS = (
    None, "NON-REACTIVE", "NOT DETECTED", "LESS THAN 15", "<15", "REPEATEDLY REACTIVE",
    "CONFIRMATION SENT", "DETECTED", "GREATER THAN 100", ">100", None, None,
    "repeatedly reactive",
)
COMMENT_LINES = (
    "HIV-1 Positive", "HIV-2 POSITIVE", "Specimen received", "HIV-1 Negative",
    "HIV-1 and HIV-2 see note",
)
PROCEDURES = ("LAB868", "LAB2005", "LAB3190")
DESCRIPTIONS = ("Hepatitis C screen", "HCV quantitative", "HIV panel")
ATC_CODES = ("J05AR03", "J05AR17", "J05AR13", "V03AB15", "N07BC01", "N07BC51")
ATC_TITLES = (
    "SOFOSBUVIR", "LEDIPASVIR AND SOFOSBUVIR", "PEGINTERFERON ALFA-2A", "VELPATASVIR",
    "sofosbuvir", *HEPATITIS_DRUGS,
)
MEDICATION_NAMES = (
    "MAVYRET", "EPCLUSA (SOFOSBUVIR)", "ZEPATIER", "PEGASYS", "mavyret", *HEPATITIS_DRUGS,
    *HEPATITIS_BRANDS,
)
ORDER_STATUSES = ("Canceled", "Sent")
DRUG_SUBCLASSES = ("Antiretroviral combo", "ANTIRETROVIRALS")
DRUG_CLASSES = ("HEPATITIS B TREATMENT AGENTS", "ANTIVIRALS")
LOGIN_LOCATIONS = ("JPS EMERGENCY", "CLINIC")
PATIENT_LOCATIONS = ("JPS EMERGENCY", "WARD")
ENCOUNTER_TYPES = ("OFFICE VISIT", "Erroneous Encounter", "HOSPITAL ENCOUNTER", "TELEPHONE")
DEPARTMENTS = (
    "HEALING WINGS CLINIC", "TRUE WORTH", "CORRECTIONAL FACILITY", "CARDIOLOGY", "PRIMARY CARE",
    "ONCOLOGY",
)
DIAGNOSIS_CODES = (
    "F10.20", "F11.20", "F12.10", "F13.20", "F14.10", "F15.20", "F16.10", "F17.210", "F18.10",
    "F19.20", "I10, F10.10",
)
DIAGNOSIS_NAMES = (
    "Alcohol dependence", "Opiate abuse", "Opioid use", "Methadone use", "Heroin use",
    "Fentanyl use", "Methamphetamine use", "Other",
)
BIRTH_DATES = ("1940-03-01", "1965-12-31", "1980-01-01", "2001-07-15")
SEXES = ("Female", "Male")
RACES = (
    "BLACK OR AFRICAN AMERICAN", "CAUCASIAN", "ASIAN", "AMERICAN INDIAN", "NATIVE HAWAIIAN",
    "OTHER", "ASIAN,CAUCASIAN",
)
ETHNIC_GROUPS = ("Hispanic, Latino or Spanish ethnicity", "Not Hispanic", "Unknown")


def nth(index: Column, values: Sequence) -> Column:
    """Value number ``index`` of the list, NULL past its end."""
    items = ", ".join("NULL" if v is None else repr(v) for v in values)
    return F.get(F.expr(f"array({items})"), index)


# Columns of the sample tables the views read.
TABLES = {
    "customer": table_schema("c_custkey bigint, c_name string, c_nationkey int"),
    "orders": table_schema(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz"
    ),
    "lineitem": table_schema(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": table_schema("event_id bigint, ts timestamp_ntz, user_id bigint"),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_source(spark, f"{folder}/{name}.parquet", TABLES[name])


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def patients(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("PAT_ID"),
        F.col("c_name").alias("PAT_MRN_ID"),
        nth(key % 5, BIRTH_DATES).cast("date").alias("BIRTH_DATE"),
        nth(key % 3, SEXES).alias("PAT_SEX"),
        nth(key % 8, RACES).alias("PATIENT_RACE"),
        nth(F.col("c_nationkey") % 4, ETHNIC_GROUPS).alias("ETHNIC_GROUP_NM"),
    )


def labs(spark: SparkSession, folder: str) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    return order_lines(spark, folder).select(
        F.col("o_custkey").alias("PAT_ID"),
        order.alias("ORDER_PROC_ID"),
        F.col("o_orderdate").alias("ORDER_INST"),
        F.col("o_orderdate").alias("SPECIMN_TAKEN_TIME"),
        F.when(supp % 10 != 9, F.col("l_shipdate")).alias("RESULT_TIME"),
        F.coalesce(nth(part % 97, COMPONENTS), F.lit(OTHER_COMPONENT)).alias("COMPONENT_ID"),
        nth((order + line) % 21, VALUES).alias("ORD_VALUE"),
        nth((supp + line) % 13, COMMENTS).alias("COMPONENT_COMMENT"),
        F.when(F.col("l_linestatus") == "F", "Completed")
        .otherwise("Canceled")
        .alias("ORDER_STATUS_NM"),
        nth(part % 97, COMPONENT_NAMES).alias("COMPONENT_NM"),
        order.alias("PAT_ENC_CSN_ID"),
        nth(line % 4, PROCEDURES).alias("PROC_CODE"),
        nth(supp % 4, DESCRIPTIONS).alias("ORDER_DESCRIPTION"),
    )


def comment_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the order lines, so that there are orders without comments too."""
    line, part = F.col("l_linenumber"), F.col("l_partkey")
    return (
        order_lines(spark, folder)
        .filter(F.col("l_suppkey") % 3 == 0)
        .select(
            F.col("o_custkey").alias("PAT_ID"),
            F.col("l_orderkey").alias("ORDER_PROC_ID"),
            (line * 100000 + part).cast("int").alias("LINE_COMMENT"),
            nth((part + line) % 6, COMMENT_LINES).alias("RESULTS_CMT"),
        )
    )


def medications(spark: SparkSession, folder: str) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    shipped, ordered = F.col("l_shipdate"), F.col("o_orderdate")
    return order_lines(spark, folder).select(
        F.col("o_custkey").alias("PAT_ID"),
        order.alias("PAT_ENC_CSN_ID"),
        nth((part + supp) % 7, ATC_CODES).alias("ATC_CODE"),
        nth(part % 199, ATC_TITLES).alias("ATC_TITLE"),
        nth(part % 193, MEDICATION_NAMES).alias("MEDICATION_NAME"),
        nth(order % 3, ORDER_STATUSES).alias("ORDER_STATUS_NM"),
        nth(part % 23, DRUG_SUBCLASSES).alias("PHARM_SBCLS_LIST"),
        nth(supp % 4, DRUG_CLASSES).alias("PHARM_CLASS_LIST"),
        F.when(supp % 7 != 0, shipped).alias("ORDERING_DATE"),
        F.when(line % 3 == 0, ordered)
        .when(line % 3 == 1, shipped + F.expr("INTERVAL '3' DAY"))
        .alias("START_DATE"),
        nth(line % 4, LOGIN_LOCATIONS).alias("ORDERING_PROV_LOGIN_LOC"),
        nth(supp % 5, PATIENT_LOCATIONS).alias("PAT_LOC_AT_ORDER"),
    )


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")

    def later(days: int) -> Column:
        return day + F.expr(f"INTERVAL '{days}' DAY")

    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("PAT_ID"),
        key.alias("PAT_ENC_CSN_ID"),
        day.alias("CONTACT_DATE"),
        F.when(F.col("o_orderstatus") == "F", "Completed")
        .when(F.col("o_orderstatus") == "O", "Canceled")
        .alias("APPT_STATUS_NM"),
        nth(key % 5, ENCOUNTER_TYPES).alias("ENC_TYPE_NM"),
        nth(key % 7, DEPARTMENTS).alias("DEPARTMENT_NAME"),
        F.when(key % 11 == 0, day).alias("HOSP_ADMSN_TIME"),
        F.when(key % 13 == 0, day).alias("HOSP_DISCH_TIME"),
        F.when(key % 3 == 0, day).alias("EMER_ADM_DATE"),
        F.when(key % 4 == 0, day)
        .when(key % 4 == 1, later(1))
        .when(key % 4 == 2, later(-1))
        .alias("INP_ADM_DATE"),
        F.when(key % 5 == 0, later(2)).alias("OP_ADM_DATE"),
    )


def diagnoses(spark: SparkSession, folder: str) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    return table(spark, folder, "events").select(
        user.alias("PAT_ID"),
        F.col("ts").alias("CONTACT_DATE"),
        nth(event % 12, DIAGNOSIS_CODES).alias("CURRENT_ICD10_LIST"),
        nth((event + user) % 9, DIAGNOSIS_NAMES).alias("DX_NAME"),
    )
