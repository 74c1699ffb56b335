"""All queries on small random tables with NULLs, repeats and ties, against their SQL."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from cohortloom.rules.code_sets import HEPATITIS_CODES, HIV_CODES
from cohortloom.sources import sample_views as views
from cohortloom.sources import schemas
from oracle.statements import statements

from .helpers import day, make

# Their SQL joins flags on PAT_ID and so has no row for an unknown patient's flags.
NEEDS_PATIENT = {"presence_flags", "diagnosis_matrix", "last_test_dates"}
CODES = [c for sets in (HEPATITIS_CODES, HIV_CODES) for g in sets.values() for c in g]
CODES += [2221, 2222] * 8 + [999]


def random_tables(seed: int, unknown_patients: bool) -> dict:
    rng = random.Random(seed)

    def one(*values, null=0.1):
        return None if rng.random() < null else rng.choice(values)

    def patient():
        return one(*range(40), null=0.1 if unknown_patients else 0)

    def date(null=0.2):
        days = [f"2020-{m:02}-{d:02}T{h:02}:00:00" for m in (1, 2) for d in (1, 9) for h in (0, 9)]
        text = one(*days, null=null)
        return text and day(text)

    statuses = ("Completed", "Completed ", "Canceled", "Canceled ", "Sent")
    places = ("JPS EMERGENCY", "JPS EMERGENCY ", "WARD")
    return {
        "patients": [
            {
                "PAT_ID": patient(),
                "PAT_MRN_ID": one("a", "b"),
                "BIRTH_DATE": one(dt.date(1960, 12, 31), dt.date(2001, 1, 1)),
                "PAT_SEX": one("Female", "Male"),
                "PATIENT_RACE": one(*views.RACES),
                "ETHNIC_GROUP_NM": one(*views.ETHNIC_GROUPS),
            }
            for _ in range(60)
        ],
        "labs": [
            {
                "PAT_ID": patient(),
                "ORDER_PROC_ID": one(*range(50)),
                "ORDER_INST": date(),
                "SPECIMN_TAKEN_TIME": date(),
                "RESULT_TIME": date(0.5),
                "COMPONENT_ID": one(*CODES),
                "ORD_VALUE": one(*views.VALUES),
                "COMPONENT_COMMENT": one(*views.COMMENTS),
                "ORDER_STATUS_NM": one(*statuses[:2], *statuses),
                "COMPONENT_NM": one(*views.COMPONENT_NAMES),
                "PAT_ENC_CSN_ID": one(*range(9)),
                "PROC_CODE": one("x", "y"),
                "ORDER_DESCRIPTION": one("x", "y"),
            }
            for _ in range(120)
        ],
        "comment_lines": [
            {
                "PAT_ID": patient(),
                "ORDER_PROC_ID": one(*range(50)),
                "LINE_COMMENT": one(1, 2, 3),
                "RESULTS_CMT": one(*views.COMMENT_LINES),
            }
            for _ in range(150)
        ],
        "meds": [
            {
                "PAT_ID": patient(),
                "PAT_ENC_CSN_ID": one(*range(9)),
                "ATC_CODE": one(*views.ATC_CODES, "V03AB15 ", "N07BC51 ", "J05AR03 "),
                "ATC_TITLE": one(*views.ATC_TITLES, "OTHER", "OTHER", "OTHER", null=0.5),
                "MEDICATION_NAME": one(*views.MEDICATION_NAMES, "OTHER", "OTHER", null=0.5),
                "ORDER_STATUS_NM": one(*statuses),
                "PHARM_SBCLS_LIST": one(*views.DRUG_SUBCLASSES, "OTHER"),
                "PHARM_CLASS_LIST": one(*views.DRUG_CLASSES),
                "ORDERING_DATE": date(),
                "START_DATE": date(),
                "ORDERING_PROV_LOGIN_LOC": one(*places),
                "PAT_LOC_AT_ORDER": one(*places),
            }
            for _ in range(200)
        ],
        "encounters": [
            {
                "PAT_ID": patient(),
                "PAT_ENC_CSN_ID": one(*range(9)),
                "CONTACT_DATE": date(),
                "APPT_STATUS_NM": one(*statuses),
                "ENC_TYPE_NM": one(*views.ENCOUNTER_TYPES),
                "DEPARTMENT_NAME": one(*views.DEPARTMENTS),
                "HOSP_ADMSN_TIME": date(0.9),
                "HOSP_DISCH_TIME": date(0.9),
                "EMER_ADM_DATE": date(),
                "INP_ADM_DATE": date(0.5),
                "OP_ADM_DATE": date(0.5),
            }
            for _ in range(150)
        ],
        "diagnoses": [
            {
                "PAT_ID": patient(),
                "CONTACT_DATE": date(0),
                "CURRENT_ICD10_LIST": one(*views.DIAGNOSIS_CODES, "I10"),
                "DX_NAME": one(*views.DIAGNOSIS_NAMES, null=0.3),
            }
            for _ in range(150)
        ],
    }


SCHEMAS = {
    "patients": (schemas.HIV_PATIENTS,),
    "labs": (schemas.LABS_WITH_REVIEW,),
    "comment_lines": (schemas.COMMENT_LINES,),
    "meds": (
        schemas.SUBSTANCE_MEDICATIONS, schemas.HIV_MEDICATIONS, schemas.HEPATITIS_MEDICATIONS,
        schemas.ACTIVE_MEDICATIONS,
    ),
    "encounters": (schemas.SUBSTANCE_ENCOUNTERS, schemas.HIV_ENCOUNTERS),
    "diagnoses": (schemas.DIAGNOSES,),
}


def merged(parts):
    fields = {f.name: f for schema in parts for f in schema.fields}
    return schemas.StructType(list(fields.values()))


@pytest.fixture(scope="module", params=[(1, True), (2, False), (3, True)], ids=str)
def case(request, spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("random")
    found, con = {}, duckdb.connect()
    for name, rows in random_tables(*request.param).items():
        make(spark, merged(SCHEMAS[name]), rows).coalesce(2).write.parquet(str(folder / name))
        found[name] = spark.read.parquet(str(folder / name))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}/*.parquet'")
    yield request.param[1], found, con
    con.close()


def test_random_tables(spark, case, monkeypatch):
    unknown_patients, tables, con = case
    monkeypatch.setattr(views, "medications", lambda s, d: tables["meds"])
    for name in ("patients", "labs", "comment_lines", "encounters", "diagnoses"):
        monkeypatch.setattr(views, name, lambda s, d, name=name: tables[name])
    sql = statements(with_views=False)
    wrong = []
    for name in statements():
        query = driver.queries()[name]
        if unknown_patients and name in NEEDS_PATIENT:
            continue
        want = con.execute(sql[name])
        columns = [c[0] for c in want.description]
        want = Counter(want.fetchall())
        got = Counter(tuple(r) for r in query(spark, "").select(*columns).collect())
        if got != want:
            wrong.append((name, got - want, want - got))
        assert want or name in ("report_page", "report_unflagged_labs"), name
    assert not [w[0] for w in wrong], wrong[0]
