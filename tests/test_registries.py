"""Whole registries on a few patients, and properties that hold on any data."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from cohortloom.operators.results import hepatitis_results, hiv_results
from cohortloom.plans import hepatitis, hiv, reports, substance_use
from cohortloom.rules.code_sets import HEPATITIS_CODES
from cohortloom.sources import sample_views as views
from cohortloom.sources import schemas

from .helpers import by, day, lab, labs, make

FOLDER = "/root/testdata/sf0.001"
D = dt.date.fromisoformat


def patients(spark, *ids, schema=schemas.HIV_PATIENTS):
    return make(spark, schema, [{"PAT_ID": i} for i in ids])


def test_evidence_without_a_date_does_not_count(spark):
    rows = [lab("REACTIVE", patient=1, RESULT_TIME=None), lab("REACTIVE", patient=2)]
    got = hepatitis.hepatitis_registry(patients(spark, 1, 2, 3, None), labs(spark, rows))
    assert by(got, "PAT_ID", "FIRST_REACTIVE_DATE", "HCV_REGISTRY_ELIGIBLE") == [
        (None, None, 0), (1, None, 0), (2, day("2020-01-02"), 1), (3, None, 0),
    ]
    assert by(hepatitis.registry_summary(got), "IN_REGISTRY", "ELIGIBLE") == [(3, 1)]


def test_repeated_patients_stay_repeated(spark):
    people = patients(spark, 1, 1, 2)
    got = hepatitis.hepatitis_registry(people, labs(spark, [lab("REACTIVE", patient=1)]))
    assert by(got, "PAT_ID", "HCV_REGISTRY_ELIGIBLE") == [(1, 1), (1, 1), (2, 0)]
    assert by(hepatitis.registry_summary(got), "IN_REGISTRY", "ELIGIBLE") == [(2, 2)]


def test_hepatitis_treatment_alone_makes_eligible(spark):
    when = day("2020-01-01")
    ordered = make(
        spark, schemas.HEPATITIS_MEDICATIONS,
        [{"PAT_ID": 1, "ATC_TITLE": "SOFOSBUVIR", "ORDERING_DATE": when},
         {"PAT_ID": 2, "ATC_TITLE": "MAVYRET", "ORDERING_DATE": when}],
    )
    active = make(
        spark, schemas.ACTIVE_MEDICATIONS,
        [{"PAT_ID": 3, "MEDICATION_NAME": "MAVYRET 100", "ORDERING_DATE": when}],
    )
    got = hepatitis.hepatitis_registry(patients(spark, 1, 2, 3), labs(spark, []), ordered, active)
    assert by(got, "PAT_ID", "FIRST_TRT_ORDER_DATE", "FIRST_TRT_ACTIVE_DATE",
              "HCV_REGISTRY_ELIGIBLE") == [
        (1, when, None, 1), (2, None, None, 0), (3, None, when, 1),
    ]
    left = reports.flagged_without_lab(got)
    assert by(left, "PAT_ID") == [(1,), (3,)]


def hiv_case(spark, rows, comments=(), meds=(), visits=(), people=(1,)):
    return hiv.hiv_registry(
        patients(spark, *people),
        labs(spark, rows),
        make(spark, schemas.COMMENT_LINES, list(comments)),
        make(spark, schemas.HIV_MEDICATIONS, list(meds)),
        make(spark, schemas.HIV_ENCOUNTERS, list(visits)),
        as_of="2020-03-01",
    )


ENGAGED = {"PAT_ID": 1, "CONTACT_DATE": day("2020-02-01"), "APPT_STATUS_NM": "Completed",
           "DEPARTMENT_NAME": "TRUE WORTH"}
ARV = {"PAT_ID": 1, "PHARM_SBCLS_LIST": "ANTIRETROVIRAL", "ATC_CODE": "J05AR13"}
CD4 = lab("500", component=1558135)


@pytest.mark.parametrize(
    "rows, comments, meds, visits, label",
    [
        ([lab("250", component=1662)], [], [], [ENGAGED], "HIVCOR"),
        ([lab("250", component=1662)], [], [], [], "Excluded"),
        ([lab("<20", component=1662)], [], [ARV], [ENGAGED], "HIVCOR"),
        ([lab("<20", component=1662)], [], [], [ENGAGED], "Excluded"),
        ([CD4], [], [ARV], [ENGAGED], "HIVCOR"),
        ([], [], [ARV], [ENGAGED], "Excluded"),
        ([lab("REACTIVE", component=273), CD4], [], [], [ENGAGED], "Excluded"),
        ([lab("REACTIVE", component=268), CD4], [], [], [ENGAGED], "HIVCOR"),
        ([lab("REACTIVE", component=1257), CD4], [], [], [ENGAGED], "HIVCOR"),
        ([lab(None, component=2221, order=5), CD4],
         [{"PAT_ID": 1, "ORDER_PROC_ID": 5, "LINE_COMMENT": 1, "RESULTS_CMT": "HIV-1 Positive"}],
         [], [ENGAGED], "HIVCOR"),
    ],
)
def test_hiv_label(spark, rows, comments, meds, visits, label):
    assert by(hiv_case(spark, rows, comments, meds, visits), "HIVCOR") == [(label,)]


def test_hiv_flags_dates_and_defaults(spark):
    rows = [
        lab("250", component=1662, ORDER_INST=day("2020-01-10T12:00:00")),
        lab("<20", component=1662, ORDER_INST=day("2020-02-10T12:00:00")),
        lab("500", component=1558134, ORDER_INST=day("2019-12-31")),
        lab("REACTIVE", component=273),
    ]
    got = hiv_case(spark, rows, people=(1, 2)).orderBy("PAT_ID").collect()
    first, second = (r.asDict() for r in got)
    assert first["RNA_RECENT_DATE"] == D("2020-02-10") and first["DAYS_SINCE_RNA"] == 20
    assert first["CD4_RECENT_DATE"] == D("2019-12-31") and first["DAYS_SINCE_CD4"] == 61
    assert [first[f] for f in hiv.FLAGS] == [1, 1, 0, 0, 0, 1, 1, 1, 0]
    assert [second[f] for f in hiv.FLAGS] == [0] * 9
    assert second["RNA_RECENT_DATE"] is None and second["DAYS_SINCE_RNA"] is None


def substance_case(spark, people, visits, dx=(), meds=()):
    return substance_use.substance_use_registry(
        make(spark, schemas.SUBSTANCE_PATIENTS, people),
        make(spark, schemas.SUBSTANCE_ENCOUNTERS, visits),
        make(spark, schemas.DIAGNOSES, list(dx)),
        make(spark, schemas.SUBSTANCE_MEDICATIONS, list(meds)),
        as_of="2020-03-01",
    )


def seen(patient):
    return {"PAT_ID": patient, "PAT_ENC_CSN_ID": patient, "CONTACT_DATE": day("2020-01-01"),
            "APPT_STATUS_NM": "Completed", "EMER_ADM_DATE": day("2020-01-01")}


def test_patients_without_a_visit_vanish(spark):
    visits = [seen(1), seen(2) | {"APPT_STATUS_NM": "Canceled"}]
    got = substance_case(spark, [{"PAT_ID": 1}, {"PAT_ID": 2}, {"PAT_ID": 3}], visits)
    assert by(got, "PAT_ID", "RECENT_CONTACT_DATE") == [(1, D("2020-01-01"))]


def test_substance_dates_and_repeated_patients(spark):
    people = [
        {"PAT_ID": 1, "PAT_SEX": "Female", "BIRTH_DATE": D("1990-01-01")},
        {"PAT_ID": 1, "PAT_SEX": "Male", "BIRTH_DATE": D("1980-01-01")},
    ]
    dx = [
        {"PAT_ID": 1, "CONTACT_DATE": day(d), "CURRENT_ICD10_LIST": "F10"}
        for d in ("2019-01-01T09:00:00", "2019-05-01T09:00:00")
    ]
    meds = [
        {"PAT_ID": 1, "PAT_ENC_CSN_ID": 1, "ATC_CODE": c, "ORDERING_DATE": day(d),
         "PAT_LOC_AT_ORDER": "JPS EMERGENCY"}
        for c, d in (("V03AB15", "2019-06-01T09:00:00"), ("N07BC51", "2019-07-01T09:00:00"))
    ]
    got = substance_case(spark, people, [seen(1)], dx, meds)
    columns = ("AGE_YRS", "SEX", "ALCOHOL_DX_DATE", "OPIOID_DX_DATE", "BUP_ORDER_DATE",
               "NALOXONE_ORDER_DATE")
    assert by(got, *columns) == [
        (40, "Male", D("2019-05-01"), None, D("2019-07-01"), D("2019-06-01"))
    ]
    assert len(got.columns) == 20


def test_unflagged_labs_repeat_with_the_patient(spark):
    rows = [
        lab("NON-REACTIVE", patient=1, COMPONENT_NM="Hepatitis c antibody"),
        lab("x", patient=1, component=5, COMPONENT_NM="hcv other", ORDER_STATUS_NM="Canceled"),
        lab("x", patient=1, component=6, COMPONENT_NM="HIV"),
        lab("REACTIVE", patient=2, COMPONENT_NM="HCV"),
    ]
    df = labs(spark, rows)
    registry = hepatitis.hepatitis_registry(patients(spark, 1, 1, 2), df)
    got = by(reports.unflagged_labs(df, registry), "PAT_ID", "COMPONENT_ID")
    assert got == [(1, 1526626), (1, 1526626), (1, 5), (1, 5)]


def test_component_service_and_combinations(spark):
    rows = [
        lab("1", COMPONENT_NM="a", SPECIMN_TAKEN_TIME=day("2020-01-03")),
        lab("1", COMPONENT_NM="a", SPECIMN_TAKEN_TIME=day("2020-01-01"), order=2),
        lab("1", component=5),
    ]
    df = labs(spark, rows)
    assert by(reports.component_service(df, HEPATITIS_CODES), "COMPONENT_ID", "min", "max") == [
        (1526626, day("2020-01-01"), day("2020-01-03"))
    ]
    assert reports.result_combinations(df).count() == 1


def test_page(spark):
    got = reports.page(spark.range(25), ["id"])
    assert [r.id for r in got.collect()] == list(range(10, 20))
    assert [r.id for r in reports.page(spark.range(25), ["id"], 20, 10).collect()] == [
        20, 21, 22, 23, 24,
    ]


# --- properties on the sample tables --------------------------------------------------------


def shuffled(df):
    return df.repartition(13, F.rand(7))


def test_partitioning_changes_nothing(spark):
    v, args = views, (spark, FOLDER)
    tables = [v.patients(*args), v.labs(*args), v.comment_lines(*args), v.medications(*args),
              v.encounters(*args)]
    plain = hiv.hiv_registry(*tables, as_of="2024-03-01")
    other = hiv.hiv_registry(*map(shuffled, tables), as_of="2024-03-01")
    assert by(plain, *plain.columns) == by(other, *plain.columns)

    tables = [v.patients(*args), v.encounters(*args), v.diagnoses(*args), v.medications(*args)]
    plain = substance_use.substance_use_registry(*tables, as_of="2024-03-01")
    other = substance_use.substance_use_registry(*map(shuffled, tables), as_of="2024-03-01")
    assert by(plain, *plain.columns) == by(other, *plain.columns)


ECHOED = {"PAT_MRN_ID", "SEX", "RACE_PRIMARY", "HISPANIC_YN", "ENC_TYPE_NM", "DEPARTMENT_NAME"}


def test_ignoring_case_means_case_changes_nothing(spark):
    def registries(change):
        v = {
            n: change(getattr(views, n)(spark, FOLDER))
            for n in ("patients", "labs", "comment_lines", "medications", "encounters",
                      "diagnoses")
        }
        meds = v["medications"]
        return [
            hepatitis.hepatitis_registry(
                v["patients"], v["labs"], meds, meds, ignore_case=True
            ),
            hiv.hiv_registry(
                v["patients"], v["labs"], v["comment_lines"], meds, v["encounters"],
                "2024-03-01", ignore_case=True,
            ),
            substance_use.substance_use_registry(
                v["patients"], v["encounters"], v["diagnoses"], meds, "2024-03-01",
                ignore_case=True,
            ),
        ]

    def folded(how):
        return lambda df: df.withColumns(
            {f.name: how(f.name) for f in df.schema if f.dataType.simpleString() == "string"}
        )

    for lower, upper in zip(registries(folded(F.lower)), registries(folded(F.upper))):
        columns = [c for c in lower.columns if c not in ECHOED]
        assert by(lower, *columns) == by(upper, *columns)


def test_one_row_per_patient(spark):
    people = views.patients(spark, FOLDER).count()
    for name in ("registry_hcv", "registry_hiv"):
        df = driver.queries()[name](spark, FOLDER)
        assert df.count() == df.select("PAT_ID").distinct().count() == people
    df = driver.queries()["registry_sud"](spark, FOLDER)
    assert df.count() == df.select("PAT_ID").distinct().count() <= people


def test_one_pass_equals_one_query_per_flag(spark):
    """The stacked aggregate against a sub-query per flag, as one would first write it."""
    results = hiv_results(views.labs(spark, FOLDER))
    lines = views.comment_lines(spark, FOLDER)
    meds, visits = views.medications(spark, FOLDER), views.encounters(spark, FOLDER)
    people = views.patients(spark, FOLDER)
    rows = people.select("PAT_ID")
    for name, cond in hiv.lab_flag_conditions().items():
        if name != "AB_DIFF_REACTIVE":
            flag = results.filter(cond).select("PAT_ID", F.lit(1).alias(name)).distinct()
            rows = rows.join(flag, "PAT_ID", "left")
    rows = rows.join(hiv.reactive_differentiation(lines, results), "PAT_ID", "left")
    rows = rows.join(hiv.last_test_dates(results), "PAT_ID", "left").fillna(0)
    got = hiv.hiv_registry(people, None, lines, meds, visits, "2024-03-01", results=results)
    columns = [c for c in got.columns if c in rows.columns]
    assert len(columns) == 11
    assert by(got, *columns) == by(rows, *columns)


def test_ready_results_can_be_passed_in(spark):
    lab_rows, people = views.labs(spark, FOLDER), views.patients(spark, FOLDER)
    direct = hepatitis.hepatitis_registry(people, lab_rows)
    ready = hepatitis.hepatitis_registry(people, results=hepatitis_results(lab_rows))
    assert by(direct, *direct.columns) == by(ready, *direct.columns)


def test_flagship(spark):
    assert [tuple(r) for r in driver.entry(spark).collect()] == [(150, by_hand(spark))]


def by_hand(spark):
    dated = hepatitis_results(views.labs(spark, FOLDER)).filter(
        "TEST_RESULT = 'Positive' AND RESULT_TIME IS NOT NULL"
    )
    return dated.select("PAT_ID").distinct().count()


@pytest.mark.parametrize("without", [(), ("medications",), ("active_medications",), ("medications", "active_medications")])
def test_hepatitis_columns_do_not_depend_on_sources(spark, without):
    sources = {
        "labs": labs(spark, [lab("REACTIVE")]),
        "medications": make(spark, schemas.HEPATITIS_MEDICATIONS, []),
        "active_medications": make(spark, schemas.ACTIVE_MEDICATIONS, []),
    }
    people = make(spark, schemas.PATIENT_IDS, [{"PAT_ID": 1}])
    full = hepatitis.hepatitis_registry(people, **sources)
    some = hepatitis.hepatitis_registry(people, **{k: v for k, v in sources.items() if k not in without})
    assert some.dtypes == full.dtypes and len(some.columns) == 7
    assert some.collect() == full.collect()


@pytest.mark.parametrize("without", ["comment_lines", "medications", "encounters"])
def test_hiv_columns_do_not_depend_on_sources(spark, without):
    sources = {
        "labs": labs(spark, [lab("REACTIVE", component=273)]),
        "comment_lines": make(spark, schemas.COMMENT_LINES, []),
        "medications": make(spark, schemas.HIV_MEDICATIONS, []),
        "encounters": make(spark, schemas.HIV_ENCOUNTERS, []),
    }
    people = make(spark, schemas.HIV_PATIENTS, [{"PAT_ID": 1}, {"PAT_ID": 2}])
    full = hiv.hiv_registry(people, **sources)
    some = hiv.hiv_registry(people, **{k: v for k, v in sources.items() if k != without})
    assert some.dtypes == full.dtypes and len(some.columns) == 23
    assert by(some, *some.columns) == by(full, *full.columns)


def test_labs_or_results_are_needed(spark):
    people = make(spark, schemas.HIV_PATIENTS, [])
    for registry in (hepatitis.hepatitis_registry, hiv.hiv_registry):
        with pytest.raises(ValueError, match="labs or results"):
            registry(people)
