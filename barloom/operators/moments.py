"""Moments per date and their combination over step windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.samples import rows_in_windows


def daily_moments(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Per date: row count, and mean and squared deviation sum of each column."""
    measures = [F.count("*").cast("double").alias("n")]
    for c in columns:
        measures += [F.avg(c).alias(f"{c}_m"), (F.var_pop(c) * F.count(c)).alias(f"{c}_ss")]
    return panel.groupBy("t").agg(*measures)


def merged(a: Column, b: Column) -> Column:
    """Moments (n, mean, ss) of two groups of rows together (Chan et al.), without large differences."""
    n = a["n"] + b["n"]
    apart = b["m"] - a["m"]
    return F.struct(n.alias("n"), (a["m"] + apart * b["n"] / n).alias("m"),
                    (a["ss"] + b["ss"] + apart * apart * a["n"] * b["n"] / n).alias("ss"))


def window_moments(daily: DataFrame, steps: DataFrame, columns: list[str]) -> DataFrame:
    """Pooled mean and population deviation per step from the per-date moments.

    One join and one aggregate: the days of a window, at most the calendar's, are merged pairwise in
    their order.
    """
    windows = steps.select("step", "train_start", "train_end")
    days = F.array_sort(F.collect_list(F.struct("t", *(
        F.struct("n", F.col(f"{c}_m").alias("m"), F.col(f"{c}_ss").alias("ss")).alias(c)
        for c in columns)))).alias("days")
    gathered = rows_in_windows(daily, windows, "train_start", "train_end").groupBy("step").agg(days)
    none = F.struct(*(F.lit(0.0).alias(n) for n in ("n", "m", "ss")))
    pooled = gathered.select("step", *(
        F.aggregate(F.col(f"days.{c}"), none, merged).alias(c) for c in columns))
    return pooled.select("step", *(e for c in columns for e in (
        F.col(f"{c}.m").alias(f"{c}_mean"),
        F.sqrt(F.col(f"{c}.ss") / F.col(f"{c}.n")).alias(f"{c}_std"))))
