"""Loading with a checked schema, writing, and materialising."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortloom.sources import schemas, tables
from cohortloom.sources.tables import (
    SchemaMismatch, check_reach, conform, materialise, read_source, working_folder, write_table,
)

from .helpers import by, day, lab, labs, make


def test_round_trip(spark, tmp_path):
    df = labs(spark, [lab("a", "b"), lab(None, None, patient=2)])
    for fmt in ("parquet", "orc", "json"):
        path = str(tmp_path / fmt)
        write_table(df, path, fmt)
        back = read_source(spark, path, schemas.LABS, fmt)
        assert back.schema == schemas.LABS
        assert by(back, *back.columns) == by(df, *back.columns)


def test_partitioned_write(spark, tmp_path):
    df = make(spark, schemas.DIAGNOSES, [{"PAT_ID": 1, "DX_NAME": "x"}, {"PAT_ID": 2}])
    write_table(df.withColumn("year", F.lit(2020)), str(tmp_path / "d"), partition_by=["year"])
    assert (tmp_path / "d" / "year=2020").is_dir()
    assert read_source(spark, str(tmp_path / "d"), schemas.DIAGNOSES).count() == 2


def test_missing_and_unfit_columns_are_reported(spark):
    df = spark.createDataFrame([("1", day("2020-01-01"))], "PAT_ID string, CONTACT_DATE timestamp")
    with pytest.raises(SchemaMismatch) as fault:
        conform(df, schemas.DIAGNOSES)
    assert "PAT_ID is string, expected bigint" in str(fault.value)
    assert "CURRENT_ICD10_LIST is missing" in str(fault.value)


def test_narrower_types_are_widened(spark):
    df = spark.createDataFrame(
        [(1, day("2020-01-01"), "F10", "x", 9)],
        "pat_id int, CONTACT_DATE timestamp_ntz, CURRENT_ICD10_LIST string, DX_NAME string, more int",
    )
    got = conform(df, schemas.DIAGNOSES)
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in schemas.DIAGNOSES
    ]
    assert by(got, "PAT_ID", "CONTACT_DATE") == [(1, day("2020-01-01"))]


def test_instants_are_refused(spark):
    df = spark.createDataFrame(
        [(1, day("2020-01-01"), "F10", "x")],
        "PAT_ID bigint, CONTACT_DATE timestamp, CURRENT_ICD10_LIST string, DX_NAME string",
    )
    with pytest.raises(SchemaMismatch, match="CONTACT_DATE is timestamp"):
        conform(df, schemas.DIAGNOSES)


HEADER = "PAT_ID,CONTACT_DATE,CURRENT_ICD10_LIST,DX_NAME"


def csv(tmp_path, *lines):
    (tmp_path / "d.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "d.csv")


def test_csv_round_trip(spark, tmp_path):
    path = csv(tmp_path, HEADER, "7,2020-01-01T00:00:00,F10,Other")
    got = read_source(spark, path, schemas.DIAGNOSES, "csv")
    assert got.collect() == [(7, day("2020-01-01"), "F10", "Other")]


@pytest.mark.parametrize(
    "lines",
    [
        ["DX_NAME,PAT_ID,CONTACT_DATE,CURRENT_ICD10_LIST", "Other,7,2020-01-01T00:00:00,F10"],
        [HEADER, "P7,2020-01-01T00:00:00,F10,Other"],
        [HEADER, "7,yesterday,F10,Other"],
        [HEADER, "7,2020-01-01T00:00:00,F10"],
    ],
)
def test_unfit_csv_is_an_error(spark, tmp_path, lines):
    with pytest.raises(Exception, match="(?i)malformed|header"):
        read_source(spark, csv(tmp_path, *lines), schemas.DIAGNOSES, "csv").collect()


def test_unfit_json_is_an_error(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"PAT_ID": "7", "DX_NAME": "Other"}\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_source(spark, str(tmp_path / "d.json"), schemas.DIAGNOSES, "json").collect()


def test_lenient_reading_cannot_be_asked_for(spark, tmp_path):
    for options in ({"mode": "PERMISSIVE"}, {"header": "false"}):
        with pytest.raises(ValueError):
            read_source(spark, str(tmp_path), schemas.DIAGNOSES, "csv", **options)


def test_materialise(spark, tmp_path):
    df = labs(spark, [lab("a"), lab("b")])
    kept = materialise(df, str(tmp_path / "labs"))
    assert by(kept, "ORD_VALUE") == [("a",), ("b",)]
    assert all(str(tmp_path / "labs") in f for f in kept.inputFiles()) and kept.inputFiles()
    with pytest.raises(Exception, match="(?i)exists"):
        materialise(df, str(tmp_path / "labs"))


def test_folders_of_one_machine_are_refused_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        for shared in (None, "", "/mnt/shar"):
            with pytest.raises(ValueError):
                check_reach("/mnt/shared/x", "file", master, shared)
        check_reach("/mnt/shared/x", "file", master, "file:///mnt/shared")
        check_reach("/x", "hdfs", master, None)
    check_reach("/tmp/x", "file", "local[8]", None)


def test_working_folders(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = working_folder(spark, "results"), working_folder(spark, "results")
    assert one != two and one.startswith(shared)
    df = labs(spark, [lab("a")])
    assert materialise(df, one).count() == 1


def test_a_schema_is_checked_once_per_session(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    schema = schemas.DIAGNOSES
    spark.createDataFrame([], schema).write.parquet(path)
    read_source(spark, path, schema)
    calls = []
    monkeypatch.setattr(tables, "conform", lambda df, schema: calls.append(1) or conform(df, schema))
    assert read_source(spark, path, schema).schema == read_source(spark, path, schema).schema
    assert len(calls) == 2
    # Another schema for the same path is checked for itself.
    with pytest.raises(SchemaMismatch):
        read_source(spark, path, schemas.LABS)
