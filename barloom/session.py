"""Session defaults and the staging helper that cuts lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC event dates and adaptive re-planning
# (partition coalescing, skewed joins, runtime broadcast by measured size).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Rows of long texts that a Python task is handed at once; Spark's own 10,000 are tens of MB.
BATCH_ROWS = 500

_local_root: str | None = None
_shipped_to: set[str] = set()


def build_session(app: str = "barloom", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    The functions that run inside tasks live in it, and executors on other machines, or
    workers started from another folder, cannot import it otherwise.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped_to:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip",
                                      package.parent, package.name)
        context.addPyFile(archive)
        _shipped_to.add(context.applicationId)
    return spark


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables and stream progress.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one machine, falls back to a temporary folder.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="barloom-")
    return _local_root


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several consumers share one expensive input: the input is scanned
    once, later readers prune columns, the planner sees real sizes, and a lost
    executor only costs a re-read.
    """
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Python tasks of what is written within get up to ``rows`` rows at once, and all of them in turn."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Staged tables of one turn of a loop, to be removed once later tables have taken their place."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[str] = []

    def stage(self, df: DataFrame, label: str = "stage") -> DataFrame:
        path = staging_path(self._spark, label)
        self._paths.append(path)
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Remove this turn's tables; nothing that is still to be computed may read them."""
        jvm = self._spark._jvm
        for path in self._paths:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(folder, True)
        self._paths.clear()
