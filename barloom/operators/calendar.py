"""Common trading dates and the dense time index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.guards import DataCheckError
from barloom.session import stage


def common_dates(features: DataFrame) -> DataFrame:
    """Dates on which every symbol has a row: one aggregation instead of N intersections."""
    symbols = features.agg(F.count_distinct("symbol")).scalar()
    return features.groupBy("date").agg(F.count_distinct("symbol").alias("n_symbols")) \
        .filter(F.col("n_symbols") == symbols).select("date")


def dense_index(dates: DataFrame) -> DataFrame:
    """``calendar(date, t)``: position of each date in time order.

    Works on distinct dates only, so the array holds at most one entry per calendar day.
    """
    ordered = dates.agg(F.array_sort(F.collect_set("date")).alias("dates"))
    return ordered.select(F.posexplode("dates").alias("t", "date")).select("date", "t")


def trading_calendar(features: DataFrame) -> DataFrame:
    return dense_index(common_dates(features))


def align(features: DataFrame, calendar: DataFrame) -> DataFrame:
    """Keep rows on common dates and attach t; the calendar is bounded by days."""
    return features.join(F.broadcast(calendar), "date")


def aligned_panel(features: DataFrame, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Aligned rows and their calendar.

    Features feed both the calendar and the rows, so they are written once, unless they
    come from a table already, and the source is scanned once.
    """
    rows = features if stored else stage(features, "features")
    calendar = stage(trading_calendar(rows), "calendar")
    return align(rows, calendar), calendar


def count_dates(calendar: DataFrame) -> int:
    return calendar.count()


def first_dates_from(calendar: DataFrame, start_date: str, n_days: int) -> DataFrame:
    """The first ``n_days`` common dates on or after ``start_date``."""
    chosen = calendar.filter(F.col("date") >= F.lit(start_date).cast("date")) \
        .orderBy("date").limit(n_days)
    found = chosen.count()
    if found < n_days:
        raise DataCheckError(f"only {found} of {n_days} test dates after {start_date}")
    return chosen


def long_enough(features: DataFrame, lookback: int) -> DataFrame:
    """Drop symbols that have no more than ``lookback`` feature rows.

    Counted in a window on the partitioning that the features already have.
    """
    counted = features.withColumn("n_rows", F.count("*").over(Window.partitionBy("symbol")))
    return counted.filter(F.col("n_rows") > lookback).drop("n_rows")


def with_history(ticks: DataFrame, features: DataFrame, lookback: int) -> DataFrame:
    """Ticks of symbols whose history is long enough."""
    counts = features.groupBy("symbol").agg(F.count("*").alias("n_rows"))
    return ticks.join(counts.filter(F.col("n_rows") > lookback), "symbol")


def to_wide(panel: DataFrame, symbols: list[str], value: str = "close",
            key: str = "date") -> DataFrame:
    """Long rows to one column per symbol."""
    return panel.groupBy(key).pivot("symbol", symbols).agg(F.first(value))


def to_long(wide: DataFrame, symbols: list[str], value: str = "close",
            key: str = "date") -> DataFrame:
    return wide.unpivot([key], symbols, "symbol", value)
