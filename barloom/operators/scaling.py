"""Scalers fitted on training windows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.moments import daily_moments, window_moments
from barloom.operators.samples import rows_in_windows, slice_range


def fit_minmax(panel: DataFrame, start: int, end: int, columns: list[str]) -> DataFrame:
    """Per symbol minimum and maximum of each column over t in [start, end]."""
    measures = [f(c).alias(f"{c}_{n}") for c in columns
                for n, f in (("min", F.min), ("max", F.max))]
    return slice_range(panel, start, end).groupBy("symbol").agg(*measures)


def _unit(column: str) -> Column:
    low, spread = F.col(f"{column}_min"), F.col(f"{column}_max") - F.col(f"{column}_min")
    return (F.col(column) - low) / F.when(spread != 0, spread).otherwise(1.0)


def apply_minmax(panel: DataFrame, params: DataFrame, columns: list[str]) -> DataFrame:
    """Scale all dates with the fitted range; a zero range divides by 1."""
    joined = panel.join(params, "symbol").withColumns({c: _unit(c) for c in columns})
    return joined.select(*panel.columns)


def inverse_close(scaled: Column, low: Column, high: Column) -> Column:
    return scaled * (high - low) + low


def close_range(params: DataFrame) -> DataFrame:
    """What undoing the scaling of close needs."""
    return params.select("symbol", "close_min", "close_max")


def fit_standard(panel: DataFrame, steps: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation per step, pooled over symbols, on training rows.

    Rows fold to moments per date first, so the step windows are joined to one row
    per date instead of to the panel.
    """
    return window_moments(daily_moments(panel, columns), steps, columns)


def apply_standard(panel: DataFrame, params: DataFrame, steps: DataFrame,
                   columns: list[str]) -> DataFrame:
    """Rows of each step from its training start to its test date, scaled."""
    fitted = steps.join(F.broadcast(params), "step")
    rows = rows_in_windows(panel, fitted, "train_start", "test_t")
    scaled = {c: (F.col(c) - F.col(f"{c}_mean"))
              / F.when(F.col(f"{c}_std") != 0, F.col(f"{c}_std")).otherwise(1.0)
              for c in columns}
    return rows.withColumns(scaled).select("step", *panel.columns)
