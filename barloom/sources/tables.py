"""Stored tables: Parquet prefixes, relational tables, in-line rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from barloom.guards import DataCheckError, require_columns, require_rows


def read_parquet_prefix(spark: SparkSession, path: str,
                        columns: Iterable[str] = ()) -> DataFrame:
    """All Parquet files under a prefix as one table; fails without files or rows."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        raise DataCheckError(f"no Parquet data under {path}") from exc
    return require_rows(require_columns(df, columns, path), path)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra: str) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "user": user, "password": password,
               "driver": driver, **extra}
    return {key: str(value) for key, value in options.items() if value is not None}


def read_relational(spark: SparkSession, options: dict[str, str],
                    partition_column: str | None = None, lower: str | None = None,
                    upper: str | None = None, partitions: int = 1) -> DataFrame:
    """Table over JDBC; give a partition column so that the read is not one task."""
    reader = spark.read.format("jdbc").options(**options)
    if partition_column:
        reader = reader.options(partitionColumn=partition_column, lowerBound=lower,
                                upperBound=upper, numPartitions=partitions)
    return reader.load()


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
