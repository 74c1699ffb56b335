"""What the corpus operators share: reading, durable intermediate tables, shipping to workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def durable_folder(spark: SparkSession) -> str:
    """The application's folder in `spark.checkpoint.dir`, which all executors share.

    Where that is unset, a temporary folder serves in local mode only, since other machines could
    not read it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or "cluster" in context.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder, with their lineage cut."""
    durable_folder(df.sparkSession)
    return df.checkpoint()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def whole_text(text: str = "text") -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def fingerprint(*parts: Column, salt: int = 0) -> Column:
    """A 64-bit hash; another salt gives an independent one."""
    return F.xxhash64(F.lit(salt), *parts)


def sorted_lines(*parts: str) -> Column:
    """kind:start:end of all spans (structs start, rank, kind, stop) by start, comma-joined."""
    spans = F.array_sort(F.concat(*parts))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )
