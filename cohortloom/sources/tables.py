"""Reading source tables with a checked schema; writing results."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Stored types that hold every value of the wanted type's source and are cast on reading.
_WIDENED = {
    "bigint": {"tinyint", "smallint", "int"},
    "int": {"tinyint", "smallint"},
    "timestamp_ntz": {"date"},
}


class SchemaMismatch(ValueError):
    """A source table lacks a column or stores it under an unfit type."""


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns, in its order and types; :class:`SchemaMismatch` if that cannot be.

    An instant (``timestamp``) is refused where a local time is wanted: which day it falls on would
    depend on the session's time zone.  Convert it in the zone it was recorded in first.
    """
    stored = {f.name.upper(): f for f in df.schema.fields}
    faults, columns = [], []
    for field in schema.fields:
        found = stored.get(field.name.upper())
        wanted = field.dataType.simpleString()
        if found is None:
            faults.append(f"{field.name} is missing")
            continue
        have = found.dataType.simpleString()
        column = F.col(f"`{found.name}`")
        if have == wanted:
            columns.append(column.alias(field.name) if found.name != field.name else column)
        elif have in _WIDENED.get(wanted, ()):
            columns.append(column.cast(field.dataType).alias(field.name))
        else:
            faults.append(f"{field.name} is {have}, expected {wanted}")
    if faults:
        raise SchemaMismatch("; ".join(faults))
    return df.select(*columns)


#: Stored schemas by session, path and what is asked of it, so that footers are read once.
_seen: dict[tuple, StructType] = {}


def read_source(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options
) -> DataFrame:
    """A source table with exactly the schema's columns.

    Formats that store a schema are checked against it, the first time a session reads the path
    for that schema.  CSV files need a header (on unless the
    option says otherwise, which is refused) that names the schema's columns in its order.  In CSV
    and JSON a value that does not fit its column ends the query; Spark looks only at columns the
    query uses, and a field that a JSON line lacks is NULL.
    """
    if "mode" in options:
        raise ValueError("rows that do not fit are never passed over: mode cannot be set")
    if fmt == "csv":
        options = {"header": True} | options
        if str(options["header"]).lower() != "true":
            raise ValueError("without a header the columns of a CSV file cannot be checked")
        options["enforceSchema"] = False
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("csv", "json"):
        return reader.schema(schema).option("mode", "FAILFAST").load(path)
    key = (spark.sparkContext.applicationId, path, fmt, schema.json(), *sorted(options.items()))
    if key not in _seen:
        df = reader.load(path)
        conform(df, schema)
        _seen[key] = df.schema
    return conform(reader.schema(_seen[key]).load(path), schema)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> None:
    """Write a result set."""
    df.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)


def materialise(
    df: DataFrame, path: str, mode: str = "errorifexists", sort_by: Sequence[str] = ()
) -> DataFrame:
    """Compute an intermediate table once, into the caller's folder, and hand back a scan of it.

    A lost executor then costs no recomputation, and several registries or reports can read the same
    results.  With ``sort_by`` the rows are dealt out by ranges of these columns and sorted in each,
    so that a reader that filters by the first skips most of the table; a further column lets the
    rows of one frequent value fill several files.  Every executor must reach the folder: outside local mode a ``file:`` path is refused
    unless it lies in the shared folder set as ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    check_reach(
        system.makeQualified(place).toUri().getPath(),
        system.getUri().getScheme(),
        spark.sparkContext.master,
        spark.conf.get("spark.checkpoint.dir", None),
    )
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    df.write.mode(mode).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_own: list[tempfile.TemporaryDirectory] = []


def working_folder(spark: SparkSession, name: str) -> str:
    """A new path for a table that the application keeps while it runs.

    It lies in the shared folder set as ``spark.checkpoint.dir``.  Where that is unset, a temporary
    folder that goes with the process serves in local mode; elsewhere it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _own:
            _own.append(tempfile.TemporaryDirectory(prefix="tables-"))
        shared = _own[0].name
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def check_reach(path: str, scheme: str, master: str, shared: str | None) -> None:
    """ValueError for a folder that other machines cannot be expected to see."""
    local = master.startswith("local") and not master.startswith("local-cluster")
    if scheme != "file" or local:
        return
    root = re.sub("^(file:)?/+", "/", shared or "").rstrip("/")
    if not root or not f"{path}/".startswith(f"{root}/"):
        raise ValueError(f"{path} is on one machine only; choose a folder all executors share")
