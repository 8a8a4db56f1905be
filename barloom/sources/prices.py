"""Daily price CSVs to bars."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.scalars import to_number
from barloom.guards import DataCheckError
from barloom.operators.bars import clean_bars

# Accepted header names of the date column, in order of preference.
DATE_HEADERS = ["Date", "date", "Datetime", "datetime"]
PRICE_HEADERS = ["Open", "High", "Low", "Close", "Volume"]


def read_price_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV rows as text plus the symbol, taken from the file stem.

    All files of one read share a header line: Spark takes one file's for all. ``by_header``
    groups files accordingly.
    """
    raw = spark.read.option("header", True).csv(path)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1)
    return raw.withColumn("symbol", _decoded(stem))


def _decoded(name: Column) -> Column:
    """A file's name or path as it is: it arrives percent-encoded, but for a plus sign, which decoding
    alone would turn into a blank."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def by_header(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """The files at ``path``, grouped by their header line; files without one are left out.

    Files are read as lines in splits, so none is held whole, and a file's header is the first line
    that is not blank of its first split. Only file names and header lines reach the driver, as with
    Spark's own file listing.
    """
    lines = spark.read.text(path).select(
        _decoded(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.regexp_replace("value", r"^\x{FEFF}", "").alias("line"))
    # The lines of a split are numbered in their order, and the fold keeps one line per file and task.
    numbered = lines.filter("start = 0 AND trim(line) <> ''").withColumn(
        "number", F.monotonically_increasing_id())
    files = numbered.groupBy("path").agg(F.min_by(F.trim("line"), "number").alias("line")).collect()
    groups: dict[str, list[str]] = {}
    for row in sorted(files):
        groups.setdefault(row["line"], []).append(row["path"])
    if not groups:
        raise DataCheckError("no price file with a header line")
    return list(groups.values())


def rows_to_bars(raw: DataFrame) -> DataFrame:
    """Pick the date header, coerce numbers, default missing columns."""
    found = [name for name in DATE_HEADERS if name in raw.columns]
    if not found:
        raise DataCheckError("price file has no date column")
    if "Close" not in raw.columns:
        raise DataCheckError("price file lacks the Close column")
    date_text = F.col(f"`{found[0]}`")
    date = F.coalesce(F.try_to_timestamp(date_text).cast("date"),
                      F.substring(date_text, 1, 10).try_cast("date"))
    close = to_number(F.col("Close"))
    prices = [
        (to_number(F.col(name)) if name in raw.columns else close).alias(name.lower())
        for name in ("Open", "High", "Low")
    ]
    volume = to_number(F.col("Volume")) if "Volume" in raw.columns else F.lit(0.0)
    return raw.select("symbol", date.alias("date"), *prices, close.alias("close"),
                      volume.alias("volume"))


def read_price_csv(spark: SparkSession, path: str | list[str],
                   symbols: Iterable[str] | None = None) -> DataFrame:
    """Bars of one file or a whole folder of ``<SYMBOL>.csv`` files, each by its own header."""
    parts = [rows_to_bars(read_price_text(spark, files)) for files in by_header(spark, path)]
    bars = reduce(DataFrame.unionByName, parts)
    if symbols is not None:
        bars = bars.filter(F.col("symbol").isin(list(symbols)))
    return clean_bars(bars)


def read_bar_cache(spark: SparkSession, path: str) -> DataFrame:
    """Bars of a cache with one folder per symbol (``sinks.files.write_bar_cache``)."""
    schema = "date string, open string, high string, low string, close string, volume string"
    raw = spark.read.schema(schema + ", symbol string").option("header", True).csv(path)
    names = {name.lower(): name for name in PRICE_HEADERS}
    return clean_bars(rows_to_bars(raw.withColumnsRenamed(names)))


def read_close_history(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Date text and close for the price-history query; unusable rows are skipped."""
    parts = [_closes(read_price_text(spark, files)) for files in by_header(spark, path)]
    return reduce(DataFrame.unionByName, parts).filter("date is not null and close is not null")


def _closes(raw: DataFrame) -> DataFrame:
    columns = {name.lower(): name for name in raw.columns}
    date = next((columns[n.lower()] for n in DATE_HEADERS if n.lower() in columns), None)
    if date is None or "close" not in columns:
        raise DataCheckError("price file lacks a date or Close column")
    return raw.select("symbol", F.col(f"`{date}`").try_cast("date").alias("date"),
                      to_number(F.col(f"`{columns['close']}`")).alias("close"))
