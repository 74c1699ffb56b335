"""The source-shaped views as SQL, one common table expression each."""

from __future__ import annotations

from cohortloom.sources import sample_views as v


def _text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _pick(index: str, values, kind: str = "VARCHAR") -> str:
    """Entry of a list by 0-based index, NULL past the end."""
    items = ", ".join(str(x) if kind == "INTEGER" else _text(x) for x in values)
    return f"([{items}]::{kind}[])[1 + ({index})::INTEGER]"


_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"

PATIENTS = f"""patients AS (
  SELECT c_custkey AS PAT_ID, c_name AS PAT_MRN_ID,
    {_pick("c_custkey % 5", v.BIRTH_DATES)}::DATE AS BIRTH_DATE,
    {_pick("c_custkey % 3", v.SEXES)} AS PAT_SEX,
    {_pick("c_custkey % 8", v.RACES)} AS PATIENT_RACE,
    {_pick("c_nationkey % 4", v.ETHNIC_GROUPS)} AS ETHNIC_GROUP_NM
  FROM customer)"""

LABS = f"""labs AS (
  SELECT o_custkey AS PAT_ID, l_orderkey AS ORDER_PROC_ID, o_orderdate AS ORDER_INST,
    o_orderdate AS SPECIMN_TAKEN_TIME,
    CASE WHEN l_suppkey % 10 <> 9 THEN l_shipdate END AS RESULT_TIME,
    coalesce({_pick("l_partkey % 97", v.COMPONENTS, "INTEGER")}, {v.OTHER_COMPONENT})
      AS COMPONENT_ID,
    {_pick("(l_orderkey + l_linenumber) % 21", v.VALUES)} AS ORD_VALUE,
    {_pick("(l_suppkey + l_linenumber) % 13", v.COMMENTS)} AS COMPONENT_COMMENT,
    CASE WHEN l_linestatus = 'F' THEN 'Completed' ELSE 'Canceled' END AS ORDER_STATUS_NM,
    {_pick("l_partkey % 97", v.COMPONENT_NAMES)} AS COMPONENT_NM,
    l_orderkey AS PAT_ENC_CSN_ID,
    {_pick("l_linenumber % 4", v.PROCEDURES)} AS PROC_CODE,
    {_pick("l_suppkey % 4", v.DESCRIPTIONS)} AS ORDER_DESCRIPTION
  FROM {_LINES})"""

COMMENTS = f"""comment_lines AS (
  SELECT o_custkey AS PAT_ID, l_orderkey AS ORDER_PROC_ID,
    (l_linenumber * 100000 + l_partkey)::INTEGER AS LINE_COMMENT,
    {_pick("(l_partkey + l_linenumber) % 6", v.COMMENT_LINES)} AS RESULTS_CMT
  FROM {_LINES} WHERE l_suppkey % 3 = 0)"""

MEDS = f"""meds AS (
  SELECT o_custkey AS PAT_ID, l_orderkey AS PAT_ENC_CSN_ID,
    {_pick("(l_partkey + l_suppkey) % 7", v.ATC_CODES)} AS ATC_CODE,
    {_pick("l_partkey % 199", v.ATC_TITLES)} AS ATC_TITLE,
    {_pick("l_partkey % 193", v.MEDICATION_NAMES)} AS MEDICATION_NAME,
    {_pick("l_orderkey % 3", v.ORDER_STATUSES)} AS ORDER_STATUS_NM,
    {_pick("l_partkey % 23", v.DRUG_SUBCLASSES)} AS PHARM_SBCLS_LIST,
    {_pick("l_suppkey % 4", v.DRUG_CLASSES)} AS PHARM_CLASS_LIST,
    CASE WHEN l_suppkey % 7 <> 0 THEN l_shipdate END AS ORDERING_DATE,
    CASE l_linenumber % 3 WHEN 0 THEN o_orderdate
      WHEN 1 THEN l_shipdate + INTERVAL 3 DAY END AS START_DATE,
    {_pick("l_linenumber % 4", v.LOGIN_LOCATIONS)} AS ORDERING_PROV_LOGIN_LOC,
    {_pick("l_suppkey % 5", v.PATIENT_LOCATIONS)} AS PAT_LOC_AT_ORDER
  FROM {_LINES})"""

ENCOUNTERS = f"""encounters AS (
  SELECT o_custkey AS PAT_ID, o_orderkey AS PAT_ENC_CSN_ID, o_orderdate AS CONTACT_DATE,
    CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Canceled' END
      AS APPT_STATUS_NM,
    {_pick("o_orderkey % 5", v.ENCOUNTER_TYPES)} AS ENC_TYPE_NM,
    {_pick("o_orderkey % 7", v.DEPARTMENTS)} AS DEPARTMENT_NAME,
    CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate END AS HOSP_ADMSN_TIME,
    CASE WHEN o_orderkey % 13 = 0 THEN o_orderdate END AS HOSP_DISCH_TIME,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS EMER_ADM_DATE,
    CASE o_orderkey % 4 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate + INTERVAL 1 DAY
      WHEN 2 THEN o_orderdate - INTERVAL 1 DAY END AS INP_ADM_DATE,
    CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL 2 DAY END AS OP_ADM_DATE
  FROM orders)"""

DIAGNOSES = f"""diagnoses AS (
  SELECT user_id AS PAT_ID, ts AS CONTACT_DATE,
    {_pick("event_id % 12", v.DIAGNOSIS_CODES)} AS CURRENT_ICD10_LIST,
    {_pick("(event_id + user_id) % 9", v.DIAGNOSIS_NAMES)} AS DX_NAME
  FROM events)"""
