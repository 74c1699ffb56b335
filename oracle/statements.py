"""One SQL statement per query, for DuckDB.

Written apart from the Spark code and in another shape: one sub-query per flag or date,
left-joined to the patients, and result rules as grouped regular expressions.
"""

from __future__ import annotations

from .views import COMMENTS, DIAGNOSES, ENCOUNTERS, LABS, MEDS, PATIENTS

AS_OF = "DATE '2024-03-01'"

_NUMBER = r"'^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *\z'"
_INTEGER = r"'^ *[+-]?[0-9]+ *\z'"


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + then.strip()


# --- laboratory results --------------------------------------------------------------------

# Fixed values.
_HCV_TYPES = """hcv_types(COMPONENT_ID, TEST_TYPE) AS (VALUES
  (1526626, 'AB'), (1230000019, 'AB'),
  (784, 'RNA'), (1811181, 'RNA'), (4338, 'RNA'), (30400316, 'RNA'), (1230001110, 'RNA'),
  (1230001112, 'RNA'), (1230001113, 'RNA'), (2236, 'RNA'), (2337, 'RNA'),
  (2618, 'Genotype'), (3061, 'Genotype'), (1230001115, 'Genotype'), (1811182, 'Genotype'))"""

_HIV_TYPES = """hiv_types(COMPONENT_ID, TEST_TYPE) AS (VALUES
  (273, 'AB'), (275, 'AB'), (587, 'AB'), (1348, 'AB'), (1496, 'AB'), (2412, 'AB'),
  (1740042, 'AB'), (30409193, 'AB'), (1230001172, 'AB'), (1234444644, 'AB'),
  (1257, 'Differentiation'), (2005, 'Differentiation'), (2221, 'Differentiation'),
  (2222, 'Differentiation'), (1612903, 'Differentiation'), (1740031, 'Differentiation'),
  (1230001157, 'Differentiation'), (1230001159, 'Differentiation'),
  (1234444746, 'Differentiation'), (1234444747, 'Differentiation'),
  (268, 'Confirmatory'), (1558004, 'Confirmatory'),
  (1497, 'RNA'), (1662, 'RNA'), (2268, 'RNA'), (2269, 'RNA'), (1510740, 'RNA'),
  (1561915, 'RNA'), (1230001158, 'RNA'), (1230001163, 'RNA'), (1230002269, 'RNA'),
  (1234101169, 'RNA'), (1234444899, 'RNA'),
  (1558135, 'CD4 Absolute'), (1230000596, 'CD4 Absolute'),
  (1558134, 'CD4 Percentage'), (1230000594, 'CD4 Percentage'))"""

_USABLE = """rtrim(ORDER_STATUS_NM) = 'Completed'
    AND NOT regexp_matches({value}, 'INVALID|INDETER|TNP|EQ')"""

_HCV_RESULTS = rf"""hcv_results AS (
  SELECT PAT_ID, ORDER_PROC_ID, ORDER_INST, SPECIMN_TAKEN_TIME, RESULT_TIME, COMPONENT_ID,
    upper(raw) AS ORD_VALUE, upper(note) AS COMPONENT_COMMENT, TEST_TYPE,
    CASE WHEN TEST_TYPE = 'RNA' AND regexp_matches(stripped, {_NUMBER})
      AND isfinite(try_cast(stripped AS DOUBLE)) THEN try_cast(stripped AS DOUBLE) END AS RNA_VALUE,
    CASE
      WHEN regexp_matches(upper(raw), '<[0-9].*DETECTED', 's') THEN 'Positive'
      WHEN TEST_TYPE = 'Genotype' AND regexp_matches(raw, '[1-6]') THEN 'Positive'
      WHEN regexp_matches(upper(note), 'NON.*REACTIVE|NOT.*DETECTED|LESS THAN|<', 's')
        THEN 'Negative'
      WHEN regexp_matches(upper(raw), 'NON|NOT.*DETECTED *\z|<', 's') THEN 'Negative'
      WHEN regexp_matches(upper(raw), 'REACTIVE|DETECTED|[0-9]') THEN 'Positive'
      WHEN regexp_matches(upper(note), 'REPEATEDLY|CONFIRMATION|DETECTED|GREATER THAN|>')
        THEN 'Positive'
    END AS TEST_RESULT,
    COMPONENT_NM
  FROM (SELECT labs.*, TEST_TYPE, ORD_VALUE AS raw, COMPONENT_COMMENT AS note,
          regexp_replace(ORD_VALUE, '[>=,]', '', 'g') AS stripped
        FROM labs JOIN hcv_types USING (COMPONENT_ID)
        WHERE {_USABLE.format(value="ORD_VALUE")}))"""

_HIV_RESULTS = rf"""hiv_results AS (
  SELECT PAT_ID, ORDER_PROC_ID, ORDER_INST, SPECIMN_TAKEN_TIME, RESULT_TIME, COMPONENT_ID,
    ORD_VALUE, COMPONENT_COMMENT, stripped AS ORD_VALUE_REPLACED, TEST_TYPE,
    CASE WHEN TEST_TYPE = 'RNA' AND regexp_matches(stripped, {_INTEGER})
      THEN try_cast(stripped AS INTEGER) END AS RNA_VALUE,
    CASE
      WHEN starts_with(ORD_VALUE, 'N') THEN 'Negative'
      WHEN regexp_matches(ORD_VALUE, '<.*Detected', 's') THEN 'Positive'
      WHEN regexp_matches(ORD_VALUE, '<|Target Not') THEN 'Negative'
      WHEN regexp_matches(ORD_VALUE, '^[RP]') THEN 'Positive'
      WHEN regexp_matches(COMPONENT_COMMENT, 'REPEATEDLY|repeatedly') THEN 'Positive'
      WHEN TEST_TYPE = 'RNA'
        AND (regexp_matches(stripped, {_NUMBER}) OR rtrim(ORD_VALUE) = 'DETECTED')
        THEN 'Positive'
    END AS TEST_RESULT
  FROM (SELECT labs.*, TEST_TYPE, regexp_replace(ORD_VALUE, '[>=,]', '', 'g') AS stripped
        FROM labs JOIN hiv_types USING (COMPONENT_ID)
        WHERE {_USABLE.format(value="coalesce(ORD_VALUE, '')")}))"""

_HCV = (LABS, _HCV_TYPES, _HCV_RESULTS)
_HIV = (LABS, _HIV_TYPES, _HIV_RESULTS)

_RESULT_COLUMNS = """PAT_ID, ORDER_PROC_ID, ORDER_INST, SPECIMN_TAKEN_TIME, RESULT_TIME,
  COMPONENT_ID, ORD_VALUE, COMPONENT_COMMENT"""

# --- hepatitis registry --------------------------------------------------------------------

_START = "CASE WHEN START_DATE < ORDERING_DATE THEN START_DATE ELSE ORDERING_DATE END"
# Fixed values.
_DRUGS = (
    "BOCEPREVIR|DACLATASVIR|DASABUVIR|ELBASVIR|GLECAPREVIR|GRAZOPREVIR|INTERFERON ALFA"
    "|LEDIPASVIR|OMBITASVIR|PARITAPREVIR|PEGINTERFERON|PIBRENTASVIR|SIMEPREVIR|SOFOSBUVIR"
    "|TELAPREVIR|VELPATASVIR|VOXILAPREVIR"
)
_BRANDS = "DAKLINZA|INCIVEK|INFERGEN|MAVYRET|OLYSIO|PEGASYS|ZEPATIER"

_ORDERED = f"""ordered AS (
  SELECT PAT_ID, min({_START}) AS FIRST_TRT_ORDER_DATE FROM meds
  WHERE regexp_matches(ATC_TITLE, '{_DRUGS}') GROUP BY ALL)"""
_ACTIVE = f"""active AS (
  SELECT PAT_ID, min({_START}) AS FIRST_TRT_ACTIVE_DATE FROM meds
  WHERE regexp_matches(MEDICATION_NAME, '{_DRUGS}|{_BRANDS}') GROUP BY ALL)"""

_LAB_EVIDENCE = """lab_evidence AS (
  SELECT PAT_ID,
    min(RESULT_TIME) FILTER (TEST_TYPE = 'AB') AS FIRST_REACTIVE_DATE,
    min(RESULT_TIME) FILTER (TEST_TYPE = 'RNA') AS FIRST_DETECTED_DATE,
    min(RESULT_TIME) FILTER (TEST_TYPE = 'Genotype') AS FIRST_GENOTYPE_DATE
  FROM hcv_results WHERE TEST_RESULT = 'Positive' GROUP BY ALL)"""

_HCV_REGISTRY = """hcv_registry AS (
  SELECT PAT_ID, FIRST_REACTIVE_DATE, FIRST_DETECTED_DATE, FIRST_GENOTYPE_DATE,
    FIRST_TRT_ORDER_DATE, FIRST_TRT_ACTIVE_DATE,
    (FIRST_REACTIVE_DATE IS NOT NULL OR FIRST_DETECTED_DATE IS NOT NULL
      OR FIRST_GENOTYPE_DATE IS NOT NULL OR FIRST_TRT_ORDER_DATE IS NOT NULL
      OR FIRST_TRT_ACTIVE_DATE IS NOT NULL)::INTEGER AS HCV_REGISTRY_ELIGIBLE
  FROM patients LEFT JOIN lab_evidence USING (PAT_ID) LEFT JOIN ordered USING (PAT_ID)
    LEFT JOIN active USING (PAT_ID))"""

_HCV_ALL = (PATIENTS, MEDS, *_HCV, _LAB_EVIDENCE, _ORDERED, _ACTIVE, _HCV_REGISTRY)

# --- HIV registry --------------------------------------------------------------------------

_POSITIVE_COMMENTS = """positive_comments AS (
  SELECT c.PAT_ID, c.ORDER_PROC_ID,
    string_agg(RESULTS_CMT, ' ' ORDER BY LINE_COMMENT ASC NULLS FIRST, RESULTS_CMT) AS COMMENT
  FROM comment_lines c JOIN hiv_results r ON r.ORDER_PROC_ID = c.ORDER_PROC_ID
  WHERE r.COMPONENT_ID IN (2221, 2222)
    AND (contains(upper(RESULTS_CMT), 'HIV-1 POSITIVE')
      OR contains(upper(RESULTS_CMT), 'HIV-2 POSITIVE'))
  GROUP BY c.PAT_ID, c.ORDER_PROC_ID)"""

_ARV = """arv AS (
  SELECT DISTINCT PAT_ID, 1 AS ARV_ORDERED FROM meds
  WHERE rtrim(ORDER_STATUS_NM) IS DISTINCT FROM 'Canceled'
    AND contains(upper(PHARM_SBCLS_LIST), 'RETROVIRAL')
    AND rtrim(PHARM_CLASS_LIST) IS DISTINCT FROM 'HEPATITIS B TREATMENT AGENTS'
    AND rtrim(ATC_CODE) NOT IN ('J05AR03', 'J05AR17'))"""

_SEEN = """seen AS (
  SELECT PAT_ID, max(CONTACT_DATE)::DATE AS LAST_SEEN_DATE,
    (max(CONTACT_DATE) FILTER (rtrim(APPT_STATUS_NM) = 'Completed' AND regexp_matches(
      DEPARTMENT_NAME, 'HEALING WINGS|TRUE WORTH|CORRECTIONAL FACILITY')))::DATE
      AS LAST_ENGAGED_DATE
  FROM encounters
  WHERE (rtrim(APPT_STATUS_NM) = 'Completed' OR HOSP_DISCH_TIME IS NOT NULL)
    AND NOT contains(upper(coalesce(ENC_TYPE_NM, '')), 'ERRONEOUS')
  GROUP BY ALL)"""

_LAST_TESTS = """last_tests AS (
  SELECT PAT_ID, (max(ORDER_INST) FILTER (TEST_TYPE = 'RNA'))::DATE AS RNA_RECENT_DATE,
    (max(ORDER_INST) FILTER (starts_with(TEST_TYPE, 'CD4')))::DATE AS CD4_RECENT_DATE
  FROM hiv_results WHERE TEST_TYPE IN ('RNA', 'CD4 Absolute', 'CD4 Percentage')
  GROUP BY ALL)"""

_LAB_FLAGS = (
    ("AB_TESTED", "TEST_TYPE = 'AB'"),
    ("AB_REACTIVE", "TEST_TYPE = 'AB' AND TEST_RESULT = 'Positive'"),
    ("AB_DIFF_TESTED", "TEST_TYPE = 'Differentiation'"),
    ("AB_DIFF_REACTIVE", "TEST_TYPE = 'Differentiation' AND TEST_RESULT = 'Positive'"),
    ("AB_CONF_REACTIVE", "TEST_TYPE = 'Confirmatory' AND TEST_RESULT = 'Positive'"),
    ("RNA_TESTED", "TEST_TYPE = 'RNA'"),
    ("RNA_DETECTED", "TEST_TYPE = 'RNA' AND TEST_RESULT = 'Positive'"),
    ("CD4_TESTED", "TEST_TYPE IN ('CD4 Absolute', 'CD4 Percentage')"),
)


def _flag(name: str, cond: str) -> str:
    return f"{name.lower()} AS (SELECT DISTINCT PAT_ID, 1 AS {name} FROM hiv_results WHERE {cond})"


_FLAG_TABLES = tuple(_flag(n, c) for n, c in _LAB_FLAGS)
_FLAG_NAMES = tuple(n for n, _ in _LAB_FLAGS)

_DIFF_UNION = """diff_union AS (
  SELECT PAT_ID, 1 AS AB_DIFF_REACTIVE FROM positive_comments
  UNION SELECT PAT_ID, 1 FROM hiv_results
    WHERE TEST_TYPE = 'Differentiation' AND TEST_RESULT = 'Positive')"""

_RACETH = """CASE
      WHEN rtrim(ETHNIC_GROUP_NM) = 'Hispanic, Latino or Spanish ethnicity' THEN 'Hispanic'
      WHEN contains(PATIENT_RACE, 'BLACK') THEN 'NH Black'
      WHEN contains(PATIENT_RACE, 'CAUCASIAN') THEN 'NH White'
      WHEN regexp_matches(PATIENT_RACE, 'ASIAN|INDIAN|HAWAIIAN|OTHER') THEN 'NH Other'
      ELSE 'Unknown' END"""

_AGE = f"(year({AS_OF}) - year(BIRTH_DATE))::INTEGER"

_HIV_REGISTRY_FLAGS = ", ".join(
    f"coalesce({'diff_union.' if n == 'AB_DIFF_REACTIVE' else ''}{n}, 0) AS {n}"
    for n in (*_FLAG_NAMES, "ARV_ORDERED")
)
_HIV_JOINS = " ".join(
    f"LEFT JOIN {'diff_union' if n == 'AB_DIFF_REACTIVE' else n.lower()} USING (PAT_ID)"
    for n in _FLAG_NAMES
)
_HIV_REGISTRY = f"""
SELECT PAT_ID, PAT_MRN_ID, AGE, SEX, RACE_PRIMARY, HISPANIC_YN, RACETH, AB_TESTED, AB_REACTIVE,
  AB_DIFF_TESTED, AB_DIFF_REACTIVE, AB_CONF_REACTIVE, RNA_TESTED, RNA_RECENT_DATE,
  date_diff('day', RNA_RECENT_DATE, {AS_OF})::INTEGER AS DAYS_SINCE_RNA, RNA_DETECTED,
  CD4_TESTED, CD4_RECENT_DATE,
  date_diff('day', CD4_RECENT_DATE, {AS_OF})::INTEGER AS DAYS_SINCE_CD4,
  ARV_ORDERED, LAST_SEEN_DATE, LAST_ENGAGED_DATE,
  CASE WHEN AB_DIFF_REACTIVE + AB_CONF_REACTIVE + RNA_DETECTED + ARV_ORDERED > 0
    AND RNA_TESTED + CD4_TESTED > 0 AND LAST_ENGAGED_DATE IS NOT NULL
    THEN 'HIVCOR' ELSE 'Excluded' END AS HIVCOR
FROM (
  SELECT PAT_ID, PAT_MRN_ID, {_AGE} AS AGE, coalesce(PAT_SEX, 'Unknown') AS SEX,
    PATIENT_RACE AS RACE_PRIMARY, ETHNIC_GROUP_NM AS HISPANIC_YN, {_RACETH} AS RACETH,
    RNA_RECENT_DATE, CD4_RECENT_DATE, LAST_SEEN_DATE, LAST_ENGAGED_DATE,
    {_HIV_REGISTRY_FLAGS}
  FROM patients {_HIV_JOINS}
    LEFT JOIN last_tests USING (PAT_ID) LEFT JOIN arv USING (PAT_ID)
    LEFT JOIN seen USING (PAT_ID))"""

# --- substance use registry ----------------------------------------------------------------

_NALOXONE = """naloxone AS (
  SELECT PAT_ID, max(ORDERING_DATE) AS NALOXONE_ORDER_DATE
  FROM meds SEMI JOIN (
      SELECT * FROM encounters
      WHERE EMER_ADM_DATE < coalesce(INP_ADM_DATE, TIMESTAMP '9999-12-31')
        AND EMER_ADM_DATE < coalesce(OP_ADM_DATE, TIMESTAMP '9999-12-31')) AS visits
    USING (PAT_ID, PAT_ENC_CSN_ID)
  WHERE rtrim(ATC_CODE) = 'V03AB15' AND 'JPS EMERGENCY' IN
      (coalesce(rtrim(ORDERING_PROV_LOGIN_LOC), ''), coalesce(rtrim(PAT_LOC_AT_ORDER), ''))
  GROUP BY ALL)"""

_BUPRENORPHINE = """buprenorphine AS (
  SELECT PAT_ID, max(ORDERING_DATE) AS BUP_ORDER_DATE FROM meds
  WHERE rtrim(ATC_CODE) IN ('N07BC01', 'N07BC51') GROUP BY ALL)"""

# Fixed values.
_OPIOIDS = "Opiate|Opioid|Methadone|Heroin|Fentanyl"
_DX = (
    ("ALCOHOL", "contains(CURRENT_ICD10_LIST, 'F10')"),
    (
        "OPIOID",
        f"contains(CURRENT_ICD10_LIST, 'F11') OR regexp_matches(DX_NAME, '{_OPIOIDS}')",
    ),
    ("CANNABIS", "contains(CURRENT_ICD10_LIST, 'F12')"),
    ("SEDATIVE", "contains(CURRENT_ICD10_LIST, 'F13')"),
    ("COCAINE", "contains(CURRENT_ICD10_LIST, 'F14')"),
    (
        "OTHER_STIMULANT",
        "contains(CURRENT_ICD10_LIST, 'F15') AND NOT contains(DX_NAME, 'Methamp')",
    ),
    ("METHAMPHETAMINE", "contains(DX_NAME, 'Methamp')"),
    ("HALLUCINOGEN", "contains(CURRENT_ICD10_LIST, 'F16')"),
    ("NICOTINE", "contains(CURRENT_ICD10_LIST, 'F17')"),
    ("INHALANT", "contains(CURRENT_ICD10_LIST, 'F18')"),
    (
        "OTHER_PSYCHOACTIVE",
        "contains(CURRENT_ICD10_LIST, 'F19')"
        f" AND NOT regexp_matches(DX_NAME, '{_OPIOIDS}|Methamp')",
    ),
)
_DX_TABLES = tuple(
    f"""{name.lower()} AS (SELECT PAT_ID, max(CONTACT_DATE)::DATE AS {name}_DX_DATE
  FROM diagnoses WHERE {cond} GROUP BY ALL)"""
    for name, cond in _DX
)
_DX_COLUMNS = ", ".join(f"{name}_DX_DATE" for name, _ in _DX)
_DX_JOINS = " ".join(f"LEFT JOIN {name.lower()} USING (PAT_ID)" for name, _ in _DX)

_LATEST = """latest AS (
  SELECT PAT_ID, CONTACT_DATE, ENC_TYPE_NM, DEPARTMENT_NAME FROM encounters
  WHERE rtrim(APPT_STATUS_NM) = 'Completed' OR HOSP_ADMSN_TIME IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY PAT_ID ORDER BY CONTACT_DATE DESC NULLS LAST,
    PAT_ENC_CSN_ID DESC NULLS LAST, ENC_TYPE_NM DESC NULLS LAST,
    DEPARTMENT_NAME DESC NULLS LAST) = 1)"""

_SEEN_PATIENTS = f"""seen_patients AS (
  SELECT PAT_ID, max({_AGE}) AS AGE_YRS, max(coalesce(PAT_SEX, 'Unknown')) AS SEX,
    max({_RACETH}) AS RACETH, CONTACT_DATE::DATE AS RECENT_CONTACT_DATE, ENC_TYPE_NM,
    DEPARTMENT_NAME
  FROM patients JOIN latest USING (PAT_ID)
  GROUP BY PAT_ID, CONTACT_DATE, ENC_TYPE_NM, DEPARTMENT_NAME)"""

# --- the statements ------------------------------------------------------------------------


def results_of_table(kind: str) -> str:
    """Classified results (``hcv`` or ``hiv``) of a table called ``labs``."""
    parts = {"hcv": (_HCV_TYPES, _HCV_RESULTS), "hiv": (_HIV_TYPES, _HIV_RESULTS)}[kind]
    return _with(*parts, then=f"SELECT * FROM {kind}_results")


def statements(with_views: bool = True) -> dict[str, str]:
    """The statements, over the sample tables or over tables named like the views."""
    views = {COMMENTS, DIAGNOSES, ENCOUNTERS, LABS, MEDS, PATIENTS}
    found = {}

    def add(name: str, *parts: str, then: str) -> None:
        if not with_views:
            parts = tuple(p for p in parts if p not in views)
        found[name] = _with(*parts, then=then) if parts else then

    tagged = """SELECT PAT_ID, ORDER_PROC_ID, labs.COMPONENT_ID, TEST_TYPE
      FROM labs JOIN {0} ON labs.COMPONENT_ID = {0}.COMPONENT_ID"""
    add("code_set_tag", LABS, _HCV_TYPES, then=tagged.format("hcv_types"))
    add("code_set_tag_hiv", LABS, _HIV_TYPES, then=tagged.format("hiv_types"))
    add("code_set_join", LABS, _HIV_TYPES, then=tagged.format("hiv_types"))
    add(
        "code_table",
        LABS,
        _HCV_TYPES,
        then="""SELECT TEST_TYPE, hcv_types.COMPONENT_ID, count(PAT_ID) AS LAB_ROWS
          FROM hcv_types LEFT JOIN labs USING (COMPONENT_ID) GROUP BY ALL""",
    )

    usable = f"SELECT {_RESULT_COLUMNS}, ORDER_STATUS_NM FROM labs WHERE "
    add("invalid_result_filter", LABS, then=usable + _USABLE.format(value="ORD_VALUE"))
    add(
        "invalid_result_filter_keep_null",
        LABS,
        then=usable + _USABLE.format(value="coalesce(ORD_VALUE, '')"),
    )
    add(
        "numeric_extract_double",
        *_HCV,
        then="SELECT ORDER_PROC_ID, COMPONENT_ID, ORD_VALUE, RNA_VALUE FROM hcv_results",
    )
    add(
        "numeric_extract_int",
        *_HIV,
        then="""SELECT ORDER_PROC_ID, COMPONENT_ID, ORD_VALUE, ORD_VALUE_REPLACED, RNA_VALUE
          FROM hiv_results""",
    )
    add(
        "classify_hcv",
        *_HCV,
        then=f"SELECT {_RESULT_COLUMNS}, TEST_TYPE, RNA_VALUE, TEST_RESULT FROM hcv_results",
    )
    add("classify_hiv", *_HIV, then="SELECT * FROM hiv_results")
    folded = "regexp_matches({}, '{}', 'i')"
    add(
        "classify_hiv_ignore_case",
        LABS,
        _HIV_TYPES,
        then=f"""SELECT PAT_ID, ORDER_PROC_ID, COMPONENT_ID, ORD_VALUE, COMPONENT_COMMENT,
          TEST_TYPE, CASE
            WHEN {folded.format("ORD_VALUE", "^N")} THEN 'Negative'
            WHEN {folded.format("ORD_VALUE", "<.*DETECTED")} THEN 'Positive'
            WHEN {folded.format("ORD_VALUE", "<|TARGET NOT")} THEN 'Negative'
            WHEN {folded.format("ORD_VALUE", "^[RP]")} THEN 'Positive'
            WHEN {folded.format("COMPONENT_COMMENT", "REPEATEDLY")} THEN 'Positive'
            WHEN TEST_TYPE = 'RNA'
              AND (regexp_matches(regexp_replace(ORD_VALUE, '[>=,]', '', 'g'), {_NUMBER})
                OR upper(rtrim(ORD_VALUE)) = 'DETECTED') THEN 'Positive'
          END AS TEST_RESULT
        FROM labs JOIN hiv_types USING (COMPONENT_ID)
        WHERE upper(rtrim(ORDER_STATUS_NM)) = 'COMPLETED'
          AND NOT regexp_matches(coalesce(ORD_VALUE, ''), 'INVALID|INDETER|TNP|EQ', 'i')""",
    )
    add(
        "classify_hcv_ignore_case",
        LABS,
        _HCV_TYPES,
        _HCV_RESULTS.replace("'INVALID|INDETER|TNP|EQ'", "'INVALID|INDETER|TNP|EQ', 'i'"),
        then=f"SELECT {_RESULT_COLUMNS}, TEST_TYPE, RNA_VALUE, TEST_RESULT FROM hcv_results",
    )
    add(
        "comment_concat",
        COMMENTS,
        *_HIV,
        _POSITIVE_COMMENTS,
        then="SELECT * FROM positive_comments",
    )
    add(
        "comment_indicator",
        COMMENTS,
        *_HIV,
        then="""SELECT r.*, (SELECT max(1) FROM comment_lines c
            WHERE c.ORDER_PROC_ID = r.ORDER_PROC_ID) AS HAS_COMMENT
          FROM hiv_results r""",
    )
    add("first_evidence_dates", *_HCV, _LAB_EVIDENCE, then="SELECT * FROM lab_evidence")
    add("first_treatment_ordered", MEDS, _ORDERED, then="SELECT * FROM ordered")
    add("first_treatment_active", MEDS, _ACTIVE, then="SELECT * FROM active")

    flagged = " UNION ".join(f"SELECT PAT_ID FROM {n.lower()}" for n in _FLAG_NAMES)
    joins = " ".join(f"LEFT JOIN {n.lower()} USING (PAT_ID)" for n in _FLAG_NAMES)
    add(
        "presence_flags",
        *_HIV,
        *_FLAG_TABLES,
        then=f"SELECT PAT_ID, {', '.join(_FLAG_NAMES)} FROM ({flagged}) {joins}",
    )
    add(
        "presence_union",
        COMMENTS,
        *_HIV,
        _POSITIVE_COMMENTS,
        _DIFF_UNION,
        then="SELECT * FROM diff_union",
    )
    add("last_test_dates", *_HIV, _LAST_TESTS, then="SELECT * FROM last_tests")
    add("arv_orders", MEDS, _ARV, then="SELECT * FROM arv")
    add("last_seen_engaged", ENCOUNTERS, _SEEN, then="SELECT * FROM seen")
    add("ed_naloxone", MEDS, ENCOUNTERS, _NALOXONE, then="SELECT * FROM naloxone")
    add("latest_drug_order", MEDS, _BUPRENORPHINE, then="SELECT * FROM buprenorphine")

    diagnosed = " UNION ".join(f"SELECT PAT_ID FROM {name.lower()}" for name, _ in _DX)
    add(
        "diagnosis_matrix",
        DIAGNOSES,
        *_DX_TABLES,
        then=f"SELECT PAT_ID, {_DX_COLUMNS} FROM ({diagnosed}) {_DX_JOINS}",
    )
    add(
        "demographics",
        PATIENTS,
        then=f"""SELECT PAT_ID, {_AGE} AS AGE, coalesce(PAT_SEX, 'Unknown') AS SEX,
          {_RACETH} AS RACETH FROM patients""",
    )
    add("latest_encounter", ENCOUNTERS, _LATEST, then="SELECT * FROM latest")
    add(
        "seen_patients",
        PATIENTS,
        ENCOUNTERS,
        _LATEST,
        _SEEN_PATIENTS,
        then="SELECT * FROM seen_patients",
    )

    add(
        "registry_hcv_labs_only",
        PATIENTS,
        *_HCV,
        _LAB_EVIDENCE,
        then="""SELECT count(DISTINCT PAT_ID) AS IN_REGISTRY, count(*) FILTER (
            FIRST_REACTIVE_DATE IS NOT NULL OR FIRST_DETECTED_DATE IS NOT NULL
              OR FIRST_GENOTYPE_DATE IS NOT NULL) AS ELIGIBLE
          FROM patients LEFT JOIN lab_evidence USING (PAT_ID)""",
    )
    add("registry_hcv", *_HCV_ALL, then="SELECT * FROM hcv_registry")
    found["registry_hcv_from_results"] = found["registry_hcv"]
    found["stored_results"] = found["classify_hcv"]
    found["stored_results_hiv"] = found["classify_hiv"]
    add(
        "registry_hcv_no_medications",
        PATIENTS,
        *_HCV,
        _LAB_EVIDENCE,
        then="""SELECT PAT_ID, FIRST_REACTIVE_DATE, FIRST_DETECTED_DATE, FIRST_GENOTYPE_DATE,
          NULL::TIMESTAMP AS FIRST_TRT_ORDER_DATE, NULL::TIMESTAMP AS FIRST_TRT_ACTIVE_DATE,
          (coalesce(FIRST_REACTIVE_DATE, FIRST_DETECTED_DATE, FIRST_GENOTYPE_DATE) IS NOT NULL)
            ::INTEGER AS HCV_REGISTRY_ELIGIBLE
          FROM patients LEFT JOIN lab_evidence USING (PAT_ID)""",
    )
    add(
        "registry_hcv_summary",
        *_HCV_ALL,
        then="""SELECT count(DISTINCT PAT_ID) AS IN_REGISTRY,
          sum(HCV_REGISTRY_ELIGIBLE)::BIGINT AS ELIGIBLE FROM hcv_registry""",
    )
    add(
        "registry_hiv",
        PATIENTS,
        COMMENTS,
        MEDS,
        ENCOUNTERS,
        *_HIV,
        _POSITIVE_COMMENTS,
        _DIFF_UNION,
        *_FLAG_TABLES,
        _LAST_TESTS,
        _ARV,
        _SEEN,
        then=_HIV_REGISTRY,
    )
    found["registry_hiv_from_results"] = found["registry_hiv"]
    add(
        "registry_sud",
        PATIENTS,
        MEDS,
        ENCOUNTERS,
        DIAGNOSES,
        _LATEST,
        _SEEN_PATIENTS,
        _NALOXONE,
        _BUPRENORPHINE,
        *_DX_TABLES,
        then=f"""SELECT seen_patients.*, {_DX_COLUMNS},
            BUP_ORDER_DATE::DATE AS BUP_ORDER_DATE,
            NALOXONE_ORDER_DATE::DATE AS NALOXONE_ORDER_DATE
          FROM seen_patients {_DX_JOINS} LEFT JOIN buprenorphine USING (PAT_ID)
            LEFT JOIN naloxone USING (PAT_ID)""",
    )

    add(
        "report_result_combinations",
        *_HCV,
        then="""SELECT DISTINCT COMPONENT_ID, COMPONENT_NM, TEST_TYPE, TEST_RESULT, ORD_VALUE,
          COMPONENT_COMMENT FROM hcv_results""",
    )
    add(
        "report_unflagged_labs",
        *_HCV_ALL,
        then="""SELECT PAT_ID, PAT_ENC_CSN_ID, PROC_CODE, ORDER_DESCRIPTION, COMPONENT_ID,
            COMPONENT_NM, ORD_VALUE, COMPONENT_COMMENT
          FROM labs JOIN hcv_registry USING (PAT_ID)
          WHERE HCV_REGISTRY_ELIGIBLE = 0
            AND regexp_matches(COMPONENT_NM, 'HCV|HEPATITIS C', 'i')""",
    )
    add(
        "report_flagged_no_lab",
        *_HCV_ALL,
        then="""SELECT * FROM hcv_registry
          WHERE coalesce(FIRST_DETECTED_DATE, FIRST_REACTIVE_DATE) IS NULL
            AND HCV_REGISTRY_ELIGIBLE = 1""",
    )
    service = """SELECT COMPONENT_ID, COMPONENT_NM, min(SPECIMN_TAKEN_TIME) AS "min",
      max(SPECIMN_TAKEN_TIME) AS "max" FROM labs SEMI JOIN {} USING (COMPONENT_ID) GROUP BY ALL"""
    add("report_component_service", LABS, _HCV_TYPES, then=service.format("hcv_types"))
    add("report_component_service_hiv", LABS, _HIV_TYPES, then=service.format("hiv_types"))
    add(
        "report_page",
        MEDS,
        ENCOUNTERS,
        _NALOXONE,
        then="SELECT * FROM naloxone ORDER BY PAT_ID NULLS FIRST LIMIT 10 OFFSET 10",
    )
    return found
