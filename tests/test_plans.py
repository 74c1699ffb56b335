"""What the plans look like, and what happens when one key holds much of a table."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from oracle.statements import statements
from cohortloom.operators.comments import positive_comments
from cohortloom.operators.encounters import latest_encounter
from cohortloom.operators.results import hepatitis_results, hiv_results, stored_results
from cohortloom.operators.skew import lookup_join
from cohortloom.plans import hepatitis, hiv, reports, substance_use
from cohortloom.sources import sample_views as views
from cohortloom.sources import schemas
from cohortloom.sources.tables import read_source

from .helpers import by

FOLDER = "/root/testdata/sf0.001"
AS_OF = "2024-03-01"
# HotSpot leaves larger methods to the bytecode interpreter.
LARGEST_COMPILED_METHOD = 8000


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The source-shaped tables as files, as a hospital would have them."""
    folder = tmp_path_factory.mktemp("sources")
    tables = {
        "patients": (views.patients, schemas.HIV_PATIENTS),
        "labs": (views.labs, schemas.LABS_WITH_REVIEW),
        "lines": (views.comment_lines, schemas.COMMENT_LINES),
        "encounters": (views.encounters, None),
        "diagnoses": (views.diagnoses, schemas.DIAGNOSES),
        "meds": (views.medications, None),
    }
    found = {}
    for name, (view, schema) in tables.items():
        df, path = view(spark, FOLDER), str(folder / name)
        df.write.parquet(path)
        found[name] = read_source(spark, path, schema or df.schema)
    return found


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {f"spark.sql.{k.replace('__', '.')}": str(v) for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df, mode="simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def registries(t) -> dict:
    return {
        "hepatitis": hepatitis.hepatitis_registry(t["patients"], t["labs"], t["meds"], t["meds"]),
        "hiv": hiv.hiv_registry(
            t["patients"], t["labs"], t["lines"], t["meds"], t["encounters"], AS_OF
        ),
        "substance": substance_use.substance_use_registry(
            t["patients"], t["encounters"], t["diagnoses"], t["meds"], AS_OF
        ),
    }


@pytest.mark.parametrize("name", sorted(statements()))
def test_no_product_join_and_no_python(spark, name):
    text = plan(driver.queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ScanExisting"):
        assert node not in text


def test_filters_and_columns_reach_the_scan(spark, stored):
    text = plan(registries(stored)["hepatitis"], "formatted")
    scans = re.findall(r"PushedFilters: (.*)\nReadSchema: struct<(.*)>", text)
    lab = [s for s in scans if "COMPONENT_ID" in s[1]]
    assert len(lab) == 1
    filters, columns = lab[0]
    assert "In(COMPONENT_ID" in filters
    assert "StringStartsWith(ORDER_STATUS_NM,Completed)" in filters
    assert "Not(StringContains(ORD_VALUE,TNP))" in filters
    assert "ORDER_INST" not in columns and "COMPONENT_NM" not in columns
    meds = [s[1] for s in scans if "START_DATE" in s[1]]
    assert sorted(len(c.split(",")) for c in meds) == [4, 4]


@pytest.mark.parametrize(
    "name, shuffles",
    [
        # one for all evidence, whose spread serves the join, and one for the patients
        ("hepatitis", 2),
        # and three small ones for the orders with positive comments
        ("hiv", 5),
        # evidence, patients, latest encounter, orders and visits in the emergency department
        ("substance", 5),
    ],
)
def test_number_of_shuffles(spark, stored, name, shuffles):
    with settings(spark, autoBroadcastJoinThreshold=-1):
        text = plan(registries(stored)[name])
    assert len(re.findall(r"\bExchange ", text)) == shuffles


@pytest.mark.parametrize("name", ["hepatitis", "hiv", "substance"])
def test_generated_methods_get_compiled(spark, stored, name):
    with settings(spark, adaptive__enabled="false"):
        text = plan(registries(stored)[name], "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < LARGEST_COMPILED_METHOD


SKEWED = {
    "autoBroadcastJoinThreshold": -1,
    "shuffle__partitions": 8,
    "adaptive__coalescePartitions__enabled": "false",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "50KB",
    "adaptive__skewJoin__skewedPartitionFactor": 2,
    "adaptive__advisoryPartitionSizeInBytes": "20KB",
}


def run(df):
    """The rows, and the plan they came from."""
    found = by(df, *df.columns)
    df.collect()
    return found, plan(df)


def with_hot_key(df, key, share=3, hot=1):
    """The table with every ``share``-th row moved to one key."""
    numbered = df.withColumn("__n", F.pmod(F.xxhash64(*df.columns), F.lit(share)))
    moved = F.when(F.col("__n") == 0, F.lit(hot)).otherwise(F.col(key))
    return numbered.withColumn(key, moved.cast(df.schema[key].dataType)).drop("__n")


@pytest.mark.parametrize("hot", [1, None])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_hot_key_is_split(spark, how, hot):
    facts = with_hot_key(
        spark.range(60_000, numPartitions=8).select(
            F.col("id").alias("row"), (F.col("id") % 5000).alias("k")
        ),
        "k",
        hot=hot,
    )
    lookup = facts.filter("k % 2 = 1").groupBy("k").agg(F.lit(1).alias("found"))
    whole = by(facts.join(lookup, "k", how), "row", "k", "found")
    with settings(spark, **SKEWED):
        df = lookup_join(facts, lookup, ["k"], how).select("row", "k", "found")
        got, text = run(df)
    assert got == whole
    if not (how == "inner" and hot is None):  # NULL keys never reach an inner join
        assert "skew=true" in text


def test_hot_order_and_hot_patient(spark, stored):
    """Comments, indicator and report stay right when a third of the rows share one key."""
    registry = hepatitis.hepatitis_registry(stored["patients"], stored["labs"])
    idle = registry.filter("HCV_REGISTRY_ELIGIBLE = 0").agg(F.min("PAT_ID")).first()[0]
    # in several partitions, since a hot one is cut by what each of them sent
    lab_rows = with_hot_key(stored["labs"], "ORDER_PROC_ID").repartition(8)
    lines = with_hot_key(stored["lines"], "ORDER_PROC_ID").repartition(8)
    hot_patient = with_hot_key(stored["labs"], "PAT_ID", hot=idle).repartition(8)

    def results():
        return [
            hiv_results(lab_rows, lines),
            positive_comments(lines, hiv_results(lab_rows)),
            reports.unflagged_labs(hot_patient, registry),
        ]

    plain = [by(df, *df.columns) for df in results()]
    small = {
        "adaptive__skewJoin__skewedPartitionThresholdInBytes": "4KB",
        "adaptive__advisoryPartitionSizeInBytes": "2KB",
    }
    with settings(spark, **SKEWED | small):
        found = [run(df) for df in results()]
    assert [rows for rows, _ in found] == plain and all(plain)
    assert ["skew=true" in text for _, text in found] == [True] * 3


def test_hot_patient_is_reduced_before_the_shuffle(spark, stored):
    """The latest encounter of a patient with a third of all encounters."""
    visits = with_hot_key(stored["encounters"], "PAT_ID").repartition(6)
    got = latest_encounter(visits)
    text = plan(got)
    # a partial aggregate sits on either side of the only shuffle by patient
    assert re.search(r"Aggregate.*max.*Exchange hashpartitioning\(PAT_ID.*partial_max", text, re.S)
    want = (
        visits.filter("APPT_STATUS_NM = 'Completed' OR HOSP_ADMSN_TIME IS NOT NULL")
        .orderBy(F.col("CONTACT_DATE").desc(), F.col("PAT_ENC_CSN_ID").desc())
        .toPandas()
        .drop_duplicates("PAT_ID")
    )
    assert by(got, "PAT_ID", "CONTACT_DATE", "ENC_TYPE_NM") == sorted(
        (
            (r.PAT_ID, r.CONTACT_DATE.to_pydatetime(), r.ENC_TYPE_NM)
            for r in want.itertuples()
        ),
        key=lambda r: str(r[0]),
    )


def scans(df):
    """The folders that the plan's file scans read, one entry per scan, and the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"FileScan parquet .*?Location: \w+\(\d+ paths?\)\[([^\],]*)", plan), plan


def test_registries_share_stored_results(spark, stored, tmp_path):
    """The laboratory table is scanned and classified by the write only."""
    stores = {
        "hcv": stored_results(hepatitis_results(stored["labs"]), str(tmp_path / "hcv")),
        "hiv": stored_results(hiv_results(stored["labs"]), str(tmp_path / "hiv")),
    }
    written, plan = scans(hiv_results(stored["labs"]))
    assert len(written) == 1 and written[0].endswith("/labs")
    registries = {
        "hcv": hepatitis.hepatitis_registry(
            stored["patients"], medications=stored["meds"], results=stores["hcv"]
        ),
        "hiv": hiv.hiv_registry(
            stored["patients"], comment_lines=stored["lines"], medications=stored["meds"],
            encounters=stored["encounters"], as_of=AS_OF, results=stores["hiv"],
        ),
    }
    for name, registry in registries.items():
        read, plan = scans(registry)
        assert not any(path.endswith("/labs") for path in read)
        assert any(path.endswith(f"/{name}") for path in read)
        # Nothing is classified anew.
        assert "REPEATEDLY" not in plan.upper()
    # The one that looks for few components asks the stored table for them.
    assert re.search(r"/hiv\].*PushedFilters: \[[^\]]*COMPONENT_ID", registries["hiv"]._jdf.queryExecution().executedPlan().toString())
    want = hiv.hiv_registry(
        stored["patients"], stored["labs"], stored["lines"], stored["meds"], stored["encounters"], AS_OF
    )
    assert by(registries["hiv"], "PAT_ID", "HIVCOR", "AB_DIFF_REACTIVE") == by(want, "PAT_ID", "HIVCOR", "AB_DIFF_REACTIVE")


def test_stored_results_lie_by_component(spark, stored, tmp_path):
    with settings(spark, adaptive__coalescePartitions__enabled="false"):
        kept = stored_results(hiv_results(stored["labs"]), str(tmp_path / "r"))
    ranges = sorted(
        kept.groupBy(F.input_file_name().alias("f"))
        .agg(F.min("COMPONENT_ID").alias("a"), F.max("COMPONENT_ID").alias("b"))
        .select("a", "b").collect()
    )
    assert len(ranges) > 2
    assert all(b[0] >= a[1] for a, b in zip(ranges, ranges[1:]))


def test_a_frequent_component_fills_several_files(spark, stored, tmp_path):
    hot = stored["labs"].withColumn("COMPONENT_ID", F.lit(784))
    with settings(spark, adaptive__coalescePartitions__enabled="false"):
        kept = stored_results(hepatitis_results(hot), str(tmp_path / "r"))
    sizes = [r["count"] for r in kept.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 2 and max(sizes) < sum(sizes) / 2
