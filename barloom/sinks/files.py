"""File sinks: Parquet, CSV reports, JSON documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.guards import require_rows


def overwrite_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replace a Parquet output; the number of files is left to Spark unless given."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").parquet(path)


def replace_prefix(df: DataFrame, uri: str) -> None:
    """Replace everything under a prefix; an empty set is refused."""
    require_rows(df, "new Parquet set").write.mode("overwrite").parquet(uri)


def write_report(df: DataFrame, path: str) -> None:
    """CSV report with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_bar_cache(bars: DataFrame, path: str) -> None:
    """CSV cache with one folder per symbol."""
    bars.hint("rebalance", "symbol").write.mode("overwrite").option("header", True) \
        .partitionBy("symbol").csv(path)


def prediction_documents(rows: DataFrame) -> DataFrame:
    """One document per run: header fields and the list of its predictions by ticker.

    A run has at most one row per ticker, so its list is bounded by the symbols.
    """
    item = F.struct("ticker", "last_close", "pred_close", "pred_return", "graph_gate")
    return rows.groupBy("prediction_run_id", "as_of_date", "model_name").agg(
        F.count("*").alias("num_nodes"), F.array_sort(F.collect_list(item)).alias("predictions"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, on any Hadoop file system."""
    fs, folder = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def output_state(spark: SparkSession, path: str) -> tuple[int, bool]:
    """Number of Parquet files and presence of the success marker."""
    names = folder_names(spark, path)
    return sum(n.endswith(".parquet") for n in names), "_SUCCESS" in names


def write_named_csv(df: DataFrame, path: str, name: str) -> None:
    """``<name>.csv`` with a header in a folder of price files; a symbol's bars are a file's worth."""
    spark = df.sparkSession
    fs, folder = _folder(spark, path)
    make = spark._jvm.org.apache.hadoop.fs.Path
    waiting = make(folder, f"_writing-{uuid.uuid4().hex}")
    df.coalesce(1).write.option("header", True).csv(waiting.toString())
    part = next(s.getPath() for s in fs.listStatus(waiting) if s.getPath().getName().endswith(".csv"))
    if not fs.rename(part, make(folder, f"{name}.csv")):
        raise OSError(f"{name}.csv could not be put into {path}")
    fs.delete(waiting, True)
