"""Hand-made edge rows for every operator."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortloom.functions import patterns as pt
from cohortloom.functions.scalars import (
    as_of_date, day_difference, earlier_of, to_double, year_difference,
)
from cohortloom.operators.codes import code_table, join_code_table, tag_codes
from cohortloom.operators.comments import comment_presence, positive_comments
from cohortloom.operators.demographics import demographics
from cohortloom.operators.diagnoses import diagnosis_dates
from cohortloom.operators.encounters import (
    emergency_encounters, last_seen_and_engaged, latest_encounter,
)
from cohortloom.operators.events import (
    first_events, last_events, latest_row, presence_flags,
)
from cohortloom.operators.results import classify, hiv_results
from cohortloom.operators.treatments import (
    arv_orders, emergency_orders, first_treatment, latest_drug_order,
)
from cohortloom.rules.code_sets import HEPATITIS_CODES, HIV_CODES
from cohortloom.rules.keywords import HEPATITIS_BRANDS, HEPATITIS_DRUGS
from cohortloom.sources import sample_views, schemas

from .helpers import by, day, lab, labs, make

D = dt.date.fromisoformat


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_patterns_on_null_and_case(spark):
    df = texts(spark, "abc", "ABC", None)
    t = F.col("t")
    assert by(df.filter(pt.any_word(t, ["b"])), "t") == [("abc",)]
    assert by(df.filter(pt.any_word(t, ["b"], ignore_case=True)), "t") == [("ABC",), ("abc",)]
    assert by(df.filter(pt.none_of(t, [pt.contains("b")])), "t") == [("ABC",)]
    kept = pt.or_null(pt.none_of(t, [pt.contains("b")]), t)
    assert by(df.filter(kept), "t") == [(None,), ("ABC",)]


def test_pattern_kinds(spark):
    df = texts(spark, "NOT DETECTED", "NOT DETECTED YET", "DETECTED NOT", "50%_x", "5000x")
    t = F.col("t")

    def found(pattern):
        return {r[0] for r in by(df.filter(pattern.on(t)), "t")}

    assert found(pt.fragments("NOT", "DETECTED")) == {"NOT DETECTED", "NOT DETECTED YET"}
    assert found(pt.fragments_at_end("NOT", "DETECTED")) == {"NOT DETECTED"}
    assert found(pt.prefix("DET")) == {"DETECTED NOT"}
    assert found(pt.fragments("0%", "_x")) == {"50%_x"}
    assert found(pt.regex("[1-6]0{3}")) == {"5000x"}


def test_equality_ignores_trailing_blanks_only(spark):
    df = texts(spark, "x", "x  ", " x", "xy", None)
    assert by(df.filter(pt.equal("x").on(F.col("t"))), "t") == [("x",), ("x  ",)]
    assert by(df.filter(pt.is_one_of(F.col("t"), ["x", "z"])), "t") == [("x",), ("x  ",)]
    assert by(df.filter(~pt.is_one_of(F.col("t"), ["x", "z"])), "t") == [(" x",), ("xy",)]
    upper = pt.is_one_of(F.col("t"), ["X"], ignore_case=True)
    assert by(df.filter(upper), "t") == [("x",), ("x  ",)]


@pytest.mark.parametrize(
    "start, ordered, want",
    [
        ("2020-01-01", None, None),
        (None, "2020-01-01", "2020-01-01"),
        ("2020-01-01", "2020-02-01", "2020-01-01"),
        ("2020-03-01", "2020-02-01", "2020-02-01"),
    ],
)
def test_earlier_of(spark, start, ordered, want):
    df = spark.createDataFrame([(start, ordered)], "a string, b string")
    assert df.select(earlier_of(F.col("a"), F.col("b"))).first()[0] == want


def test_date_differences(spark):
    df = spark.createDataFrame(
        [(D("2000-12-31"), day("2001-01-01T23:59:00"))], "a date, b timestamp_ntz"
    )
    a, b = F.col("a"), F.col("b")
    got = df.select(year_difference(a, b), day_difference(a, b), year_difference(b, a)).first()
    assert tuple(got) == (1, 1, -1)


def test_as_of(spark):
    one = spark.range(1)
    assert one.select(as_of_date("2024-03-01")).first()[0] == D("2024-03-01")
    assert one.select(as_of_date(D("2024-03-01"))).first()[0] == D("2024-03-01")
    assert one.select(as_of_date() == F.current_date()).first()[0]
    assert one.select(as_of_date(F.lit("2024-03-01"))).first()[0] == D("2024-03-01")


@pytest.mark.parametrize("sets, size", [(HEPATITIS_CODES, 15), (HIV_CODES, 37)])
def test_code_sets_do_not_overlap(spark, sets, size):
    codes = [c for group in sets.values() for c in group]
    assert len(codes) == len(set(codes)) == code_table(spark, sets).count()
    assert len(codes) == size


def test_tagging_by_literal_and_by_table_agree(spark):
    codes = [c for group in HIV_CODES.values() for c in group] + [999, None]
    df = labs(spark, [lab(component=c) for c in codes])
    columns = ("COMPONENT_ID", "TEST_TYPE")
    literal = by(tag_codes(df, HIV_CODES), *columns)
    assert literal == by(join_code_table(df, code_table(spark, HIV_CODES)), *columns)
    assert literal == sorted(
        ((c, t) for t, group in HIV_CODES.items() for c in group), key=lambda r: str(r[0])
    )


def test_first_last_and_presence(spark):
    rows = [
        (1, "a", day("2020-02-01T10:00:00")),
        (1, "a", day("2020-01-01T10:00:00")),
        (1, "b", None),
        (2, "b", None),
        (3, "c", day("2020-01-01")),
    ]
    df = spark.createDataFrame(rows, "PAT_ID bigint, k string, t timestamp_ntz")
    kinds = {"A": F.col("k") == "a", "B": F.col("k") == "b"}
    for early in (True, False):
        assert by(first_events(df, kinds, "t", filter_rows=early), "PAT_ID", "A", "B") == [
            (1, day("2020-01-01T10:00:00"), None),
            (2, None, None),
        ]
        assert by(last_events(df, kinds, "t", filter_rows=early), "PAT_ID", "A", "B") == [
            (1, D("2020-02-01"), None),
            (2, None, None),
        ]
        flags = presence_flags(df, kinds, filter_rows=early)
        assert by(flags, "PAT_ID", "A", "B") == [(1, 1, 1), (2, None, 1)]
    # a single kind of event
    assert by(first_events(df, {"A": kinds["A"]}, "t"), "PAT_ID") == [(1,)]


def comment(order, line, text, patient=1):
    return {"PAT_ID": patient, "ORDER_PROC_ID": order, "LINE_COMMENT": line, "RESULTS_CMT": text}


def test_comment_text(spark):
    results = hiv_results(
        labs(
            spark,
            [
                lab("x", component=2221, order=1),
                lab("x", component=2221, order=2),
                lab("x", component=2222, order=2),
                lab("x", component=1257, order=3),
                lab("INVALID", component=2221, order=4),
            ],
        )
    )
    lines = make(
        spark,
        schemas.COMMENT_LINES,
        [
            comment(1, 10, "Hiv-2 positive"),
            comment(1, 9, "HIV-1 POSITIVE"),
            comment(1, 8, "Specimen received"),
            comment(1, None, "no line: HIV-1 positive"),
            comment(1, 9, "HIV-1 POSITIVE", patient=7),
            comment(2, 1, "HIV-1 Positive"),
            comment(2, 2, "HIV-2 Positive"),
            comment(2, 2, "HIV-2 Positive !", patient=8),
            comment(2, 2, "HIV-2 Positive", patient=8),
            comment(3, 1, "HIV-1 Positive"),
            comment(4, 1, "HIV-1 Positive"),
            comment(5, 1, "HIV-1 Positive"),
        ],
    )
    assert by(positive_comments(lines, results), "ORDER_PROC_ID", "PAT_ID", "COMMENT") == [
        (1, 1, "no line: HIV-1 positive HIV-1 POSITIVE Hiv-2 positive"),
        (1, 7, "HIV-1 POSITIVE"),
        (2, 1, "HIV-1 Positive HIV-1 Positive HIV-2 Positive HIV-2 Positive"),
        (2, 8, "HIV-2 Positive HIV-2 Positive HIV-2 Positive ! HIV-2 Positive !"),
    ]


def test_comment_indicator(spark):
    lines = make(spark, schemas.COMMENT_LINES, [comment(1, 1, "a"), comment(1, 2, None)])
    df = labs(spark, [lab("x", component=273, order=o) for o in (1, 2, None)])
    assert by(comment_presence(lines), "ORDER_PROC_ID", "HAS_COMMENT") == [(1, 1)]
    assert by(hiv_results(df, lines), "ORDER_PROC_ID", "HAS_COMMENT") == [
        (None, None), (1, 1), (2, None),
    ]


def test_first_treatment(spark):
    early, late = day("2020-01-01"), day("2020-02-01")
    meds = make(
        spark,
        schemas.HEPATITIS_MEDICATIONS,
        [
            {"PAT_ID": 1, "ATC_TITLE": "SOFOSBUVIR", "START_DATE": late, "ORDERING_DATE": late},
            {"PAT_ID": 1, "ATC_TITLE": "a LEDIPASVIR b", "START_DATE": early,
             "ORDERING_DATE": late},
            {"PAT_ID": 2, "ATC_TITLE": "SOFOSBUVIR", "START_DATE": early},
            {"PAT_ID": 3, "ATC_TITLE": "sofosbuvir", "ORDERING_DATE": late},
            {"PAT_ID": 4, "ORDERING_DATE": late},
        ],
    )
    drugs = ("SOFOSBUVIR", "LEDIPASVIR")
    assert by(first_treatment(meds, "ATC_TITLE", drugs, "T"), "PAT_ID", "T") == [
        (1, early), (2, None),
    ]
    folded = first_treatment(meds, "ATC_TITLE", drugs, "T", ignore_case=True)
    assert by(folded, "PAT_ID", "T") == [(1, early), (2, None), (3, late)]


def test_arv_orders(spark):
    good = {
        "ORDER_STATUS_NM": "Sent", "PHARM_SBCLS_LIST": "Antiretroviral",
        "PHARM_CLASS_LIST": "ANTIVIRALS", "ATC_CODE": "J05AR13",
    }
    changes = [
        {},
        {"ORDER_STATUS_NM": None},
        {"ORDER_STATUS_NM": "Canceled"},
        {"ORDER_STATUS_NM": "Canceled "},
        {"PHARM_SBCLS_LIST": None},
        {"PHARM_SBCLS_LIST": "other"},
        {"PHARM_CLASS_LIST": None},
        {"PHARM_CLASS_LIST": "HEPATITIS B TREATMENT AGENTS"},
        {"PHARM_CLASS_LIST": "HEPATITIS B TREATMENT AGENTS, ANTIVIRALS"},
        {"ATC_CODE": None},
        {"ATC_CODE": "J05AR03"},
        {"ATC_CODE": "J05AR17"},
    ]
    rows = [good | c | {"PAT_ID": i} for i, c in enumerate(changes)] + [good | {"PAT_ID": 0}]
    got = by(arv_orders(make(spark, schemas.HIV_MEDICATIONS, rows)), "PAT_ID", "ARV_ORDERED")
    assert got == [(0, 1), (1, 1), (6, 1), (8, 1)]


def test_emergency_encounters(spark):
    base = day("2020-01-02")
    before, after = day("2020-01-01"), day("2020-01-03")
    cases = [
        (base, None, None), (base, after, None), (base, None, after), (base, base, None),
        (base, None, base), (base, before, None), (base, after, before), (None, after, after),
    ]
    rows = [
        {"PAT_ID": i, "PAT_ENC_CSN_ID": i, "EMER_ADM_DATE": e, "INP_ADM_DATE": p,
         "OP_ADM_DATE": o}
        for i, (e, p, o) in enumerate(cases)
    ]
    df = make(spark, schemas.SUBSTANCE_ENCOUNTERS, rows)
    assert by(emergency_encounters(df), "PAT_ID") == [(0,), (1,), (2,)]


def test_emergency_orders(spark):
    when, later = day("2020-01-01"), day("2020-01-05")
    encounters = make(
        spark,
        schemas.SUBSTANCE_ENCOUNTERS,
        [{"PAT_ID": p, "PAT_ENC_CSN_ID": c, "EMER_ADM_DATE": when}
         for p, c in ((1, 10), (1, 10), (2, 20), (3, 30), (4, 40))],
    )
    ed = "JPS EMERGENCY"

    def order(patient, visit, login=None, place=None, code="V03AB15", time=when):
        return {"PAT_ID": patient, "PAT_ENC_CSN_ID": visit, "ATC_CODE": code,
                "ORDERING_DATE": time, "ORDERING_PROV_LOGIN_LOC": login,
                "PAT_LOC_AT_ORDER": place}

    meds = make(
        spark,
        schemas.SUBSTANCE_MEDICATIONS,
        [
            order(1, 10, ed), order(1, 10, None, ed, time=later), order(1, 11, ed, time=None),
            order(2, 20, "CLINIC", "WARD"), order(3, 30, ed, code="N07BC01"),
            order(4, 10, ed), order(4, 40, ed, time=None), order(None, 40, ed),
        ],
    )
    got = emergency_orders(meds, encounters)
    assert by(got, "PAT_ID", "NALOXONE_ORDER_DATE") == [(1, later), (4, None)]
    got = latest_drug_order(meds, ("N07BC01", "N07BC51"), "BUP_ORDER_DATE")
    assert by(got, "PAT_ID", "BUP_ORDER_DATE") == [(3, when)]


def test_last_seen_and_engaged(spark):
    def visit(patient, date, status="Completed", kind="OFFICE", place="CARDIOLOGY", out=None):
        return {"PAT_ID": patient, "CONTACT_DATE": day(date), "APPT_STATUS_NM": status,
                "ENC_TYPE_NM": kind, "DEPARTMENT_NAME": place,
                "HOSP_DISCH_TIME": out and day(out)}

    rows = [
        visit(1, "2020-01-01T08:00:00", place="THE TRUE WORTH SITE"),
        visit(1, "2020-02-01", kind=None),
        visit(1, "2020-03-01", kind="Erroneous Encounter"),
        visit(1, "2020-04-01", status="Canceled"),
        visit(2, "2020-01-01", status=None, out="2020-01-02", place="HEALING WINGS"),
        visit(3, "2020-01-01", status="Canceled", place="HEALING WINGS"),
        visit(4, "2020-01-01", place=None),
    ]
    got = last_seen_and_engaged(make(spark, schemas.HIV_ENCOUNTERS, rows))
    assert by(got, "PAT_ID", "LAST_SEEN_DATE", "LAST_ENGAGED_DATE") == [
        (1, D("2020-02-01"), D("2020-01-01")),
        (2, D("2020-01-01"), None),
        (4, D("2020-01-01"), None),
    ]


def test_latest_encounter(spark):
    def visit(patient, number, date, kind, status="Completed", admitted=None):
        return {"PAT_ID": patient, "PAT_ENC_CSN_ID": number, "CONTACT_DATE": date and day(date),
                "ENC_TYPE_NM": kind, "APPT_STATUS_NM": status, "DEPARTMENT_NAME": kind,
                "HOSP_ADMSN_TIME": admitted and day(admitted)}

    rows = [
        visit(1, 1, "2020-01-01", "old"),
        visit(1, 3, "2020-02-01", "tie, higher number"),
        visit(1, 2, "2020-02-01", "tie, lower number"),
        visit(1, 4, "2020-03-01", "not completed", status=None),
        visit(2, 1, "2020-01-01", None, status="Canceled", admitted="2020-01-01"),
        visit(3, 1, None, "no date"),
        visit(3, 0, "1900-01-01", "dated"),
        visit(4, 1, "2020-01-01", "canceled", status="Canceled"),
    ]
    got = latest_encounter(make(spark, schemas.SUBSTANCE_ENCOUNTERS, rows))
    assert by(got, "PAT_ID", "ENC_TYPE_NM", "DEPARTMENT_NAME") == [
        (1, "tie, higher number", "tie, higher number"), (2, None, None), (3, "dated", "dated"),
    ]


def test_latest_row_is_row_number_one(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 40).alias("PAT_ID"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 31 % 17).alias("a"),
        (F.col("id") * 17 % 101).alias("b"),
        F.col("id").alias("c"),
    )
    last_first = [F.col(n).desc_nulls_last() for n in ("a", "b", "c")]
    rank = F.row_number().over(Window.partitionBy("PAT_ID").orderBy(*last_first))
    want = df.withColumn("rank", rank).filter("rank = 1")
    assert by(latest_row(df, ("a", "b"), ("c",)), *df.columns) == by(want, *df.columns)


def diagnoses(spark, *rows):
    return make(
        spark,
        schemas.DIAGNOSES,
        [
            {"PAT_ID": i, "CONTACT_DATE": day("2020-01-01"), "CURRENT_ICD10_LIST": c, "DX_NAME": n}
            for i, (c, n) in enumerate(rows)
        ],
    )


def test_diagnosis_rules(spark):
    cases = [
        ("F10.1, F17.2", "x", {"ALCOHOL", "NICOTINE"}),
        ("F11.20", None, {"OPIOID"}),
        (None, "Opiate abuse", {"OPIOID"}),
        (None, "Methadone", {"OPIOID"}),
        (None, "Heroin", {"OPIOID"}),
        (None, "Fentanyl", {"OPIOID"}),
        (None, "opioid", set()),
        ("F12", None, {"CANNABIS"}),
        ("F13", None, {"SEDATIVE"}),
        ("F14", None, {"COCAINE"}),
        ("F15", "other", {"OTHER_STIMULANT"}),
        ("F15", None, set()),
        ("F15", "Methamphetamine", {"METHAMPHETAMINE"}),
        ("F16", None, {"HALLUCINOGEN"}),
        ("F18", None, {"INHALANT"}),
        ("F19", "other", {"OTHER_PSYCHOACTIVE"}),
        ("F19", None, set()),
        ("F19", "Opioid", {"OPIOID"}),
        ("F19", "Methamp", {"METHAMPHETAMINE"}),
        ("I10", "other", set()),
    ]
    got = diagnosis_dates(diagnoses(spark, *(c[:2] for c in cases))).collect()
    found = {
        r.PAT_ID: {c.removesuffix("_DX_DATE") for c, v in r.asDict().items()
                   if c != "PAT_ID" and v is not None}
        for r in got
    }
    assert found == {i: c[2] for i, c in enumerate(cases) if c[2]}
    assert {v for r in got for v in r[1:] if v is not None} == {D("2020-01-01")}


def test_demographics(spark):
    hispanic = "Hispanic, Latino or Spanish ethnicity"
    cases = [
        ("BLACK", hispanic, "Hispanic"),
        ("BLACK OR AFRICAN AMERICAN", None, "NH Black"),
        ("ASIAN,CAUCASIAN", "Not Hispanic", "NH White"),
        ("ASIAN", None, "NH Other"),
        ("AMERICAN INDIAN", None, "NH Other"),
        ("NATIVE HAWAIIAN", None, "NH Other"),
        ("OTHER", None, "NH Other"),
        ("BLACK,CAUCASIAN", None, "NH Black"),
        ("CAUCASIAN", "Hispanic", "NH White"),
        ("caucasian", None, "Unknown"),
        (None, None, "Unknown"),
    ]
    rows = [
        {"PAT_ID": i, "PATIENT_RACE": r, "ETHNIC_GROUP_NM": e, "BIRTH_DATE": D("2000-12-31")}
        for i, (r, e, _) in enumerate(cases)
    ]
    rows.append({"PAT_ID": 99, "PAT_SEX": "Female"})
    got = demographics(make(spark, schemas.HIV_PATIENTS, rows), "2001-01-01")
    assert by(got.filter("PAT_ID = 99"), "AGE", "SEX", "RACETH") == [(None, "Female", "Unknown")]
    got = {r.PAT_ID: r for r in got.filter("PAT_ID < 99").collect()}
    assert [got[i].RACETH for i in range(len(cases))] == [c[2] for c in cases]
    assert {(r.AGE, r.SEX) for r in got.values()} == {(1, "Unknown")}


@pytest.mark.parametrize("code_sets", [{"Crohn's": (1,), "a\\b": (2, 3)}])
def test_names_of_code_sets_are_any_text(spark, code_sets):
    got = code_table(spark, code_sets)
    assert by(got, "COMPONENT_ID", "TEST_TYPE") == [(1, "Crohn's"), (2, "a\\b"), (3, "a\\b")]


def test_a_code_in_two_sets_is_refused(spark):
    sets = {"a": (1, 2), "b": (2,)}
    for use in (lambda: code_table(spark, sets), lambda: tag_codes(spark.range(1), sets, "id")):
        with pytest.raises(ValueError, match="code 2"):
            use()


def test_too_large_numbers_and_no_rules(spark):
    df = spark.createDataFrame([("1e999",), ("-1e999",), ("1e9",), ("x",)], "t string")
    got = [r[0] for r in df.select(to_double(F.col("t"))).collect()]
    assert got == [None, None, 1e9, None]
    assert df.select(classify([]).alias("c")).dtypes == [("c", "string")]


@pytest.mark.parametrize("word", HEPATITIS_DRUGS + HEPATITIS_BRANDS)
def test_every_drug_name_starts_a_treatment(spark, word):
    names = HEPATITIS_DRUGS + HEPATITIS_BRANDS
    row = {"PAT_ID": 1, "MEDICATION_NAME": f"x {word} y", "START_DATE": None, "ORDERING_DATE": day("2020-01-01")}
    meds = make(spark, schemas.ACTIVE_MEDICATIONS, [row])
    assert by(first_treatment(meds, "MEDICATION_NAME", names, "D"), "PAT_ID") == [(1,)]
    assert word in sample_views.MEDICATION_NAMES


def test_sample_views_hold_every_code():
    codes = {c for s in (HEPATITIS_CODES, HIV_CODES) for group in s.values() for c in group}
    assert set(sample_views.COMPONENTS) == codes and len(codes) == 52
    assert set(HEPATITIS_DRUGS) <= set(sample_views.ATC_TITLES)
