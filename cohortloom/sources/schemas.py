"""Columns and types the registries read from each source table."""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import StructType

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def table_schema(text: str) -> StructType:
    """``name type`` pairs; unlike DDL parsing this needs no running session."""
    schema = StructType()
    for column in text.split(","):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


LABS = table_schema(
    "PAT_ID bigint, ORDER_PROC_ID bigint, ORDER_INST timestamp_ntz,"
    " SPECIMN_TAKEN_TIME timestamp_ntz, RESULT_TIME timestamp_ntz, COMPONENT_ID int,"
    " ORD_VALUE string, COMPONENT_COMMENT string, ORDER_STATUS_NM string"
)
LAB_REVIEW = table_schema(
    "COMPONENT_NM string, PAT_ENC_CSN_ID bigint, PROC_CODE string, ORDER_DESCRIPTION string"
)
LABS_WITH_REVIEW = StructType(LABS.fields + LAB_REVIEW.fields)
COMMENT_LINES = table_schema(
    "PAT_ID bigint, ORDER_PROC_ID bigint, LINE_COMMENT int, RESULTS_CMT string"
)
HEPATITIS_MEDICATIONS = table_schema(
    "PAT_ID bigint, ATC_TITLE string, START_DATE timestamp_ntz, ORDERING_DATE timestamp_ntz"
)
ACTIVE_MEDICATIONS = table_schema(
    "PAT_ID bigint, MEDICATION_NAME string, START_DATE timestamp_ntz, ORDERING_DATE timestamp_ntz"
)
HIV_MEDICATIONS = table_schema(
    "PAT_ID bigint, ORDER_STATUS_NM string, PHARM_SBCLS_LIST string, PHARM_CLASS_LIST string,"
    " ATC_CODE string"
)
SUBSTANCE_MEDICATIONS = table_schema(
    "PAT_ID bigint, PAT_ENC_CSN_ID bigint, ATC_CODE string, ORDERING_DATE timestamp_ntz,"
    " ORDERING_PROV_LOGIN_LOC string, PAT_LOC_AT_ORDER string"
)
HIV_ENCOUNTERS = table_schema(
    "PAT_ID bigint, CONTACT_DATE timestamp_ntz, APPT_STATUS_NM string,"
    " HOSP_DISCH_TIME timestamp_ntz, ENC_TYPE_NM string, DEPARTMENT_NAME string"
)
SUBSTANCE_ENCOUNTERS = table_schema(
    "PAT_ID bigint, PAT_ENC_CSN_ID bigint, CONTACT_DATE timestamp_ntz,"
    " EMER_ADM_DATE timestamp_ntz, INP_ADM_DATE timestamp_ntz, OP_ADM_DATE timestamp_ntz,"
    " APPT_STATUS_NM string, HOSP_ADMSN_TIME timestamp_ntz, ENC_TYPE_NM string,"
    " DEPARTMENT_NAME string"
)
DIAGNOSES = table_schema(
    "PAT_ID bigint, CONTACT_DATE timestamp_ntz, CURRENT_ICD10_LIST string, DX_NAME string"
)
PATIENT_IDS = table_schema("PAT_ID bigint")
SUBSTANCE_PATIENTS = table_schema(
    "PAT_ID bigint, BIRTH_DATE date, PAT_SEX string, PATIENT_RACE string, ETHNIC_GROUP_NM string"
)
HIV_PATIENTS = StructType(SUBSTANCE_PATIENTS.fields + table_schema("PAT_MRN_ID string").fields)
