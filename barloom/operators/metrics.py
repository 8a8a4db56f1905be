"""Forecast evaluation over ``(model, step, date, ticker, y_true, y_pred, last_close, gate)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def squared_error() -> Column:
    return F.pow(F.col("y_true") - F.col("y_pred"), 2)


def direction_hit(eps: float = 0.0) -> Column:
    actual = (F.col("y_true") - F.col("last_close")) > eps
    predicted = (F.col("y_pred") - F.col("last_close")) > eps
    return (actual == predicted).cast("double")


def forecast_metrics(forecasts: DataFrame, by: list[str], eps: float = 0.0) -> DataFrame:
    """MSE, MAE, RMSE and directional accuracy in one pass."""
    return forecasts.groupBy(*by).agg(
        F.avg(squared_error()).alias("mse"),
        F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae"),
        F.sqrt(F.avg(squared_error())).alias("rmse"),
        F.avg(direction_hit(eps)).alias("directional_accuracy"))


def leaderboard(forecasts: DataFrame, eps: float = 0.0, window: str | None = None) -> DataFrame:
    """Models by ascending MSE, with a window label when given."""
    table = forecast_metrics(forecasts, ["model"], eps)
    if window is not None:
        table = table.withColumn("window", F.lit(window))
    return table.orderBy("mse", "model")


def day_mse(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("model", "step", "date").agg(F.avg(squared_error()).alias("day_mse"))


def symbol_mse(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("model", "ticker").agg(F.avg(squared_error()).alias("mse"))


def compare_models(errors: DataFrame, keys: list[str], value: str,
                   contests: list[tuple[str, str]], suffix: str) -> DataFrame:
    """One column per model, then who beats whom and by how much.

    ``contests`` are (challenger, base) pairs. Keys that lack one of the models drop
    out, as in an inner join of the model tables.
    """
    models = sorted({m for pair in contests for m in pair})
    wide = errors.groupBy(*keys).pivot("model", models).agg(F.first(value)).dropna(subset=models)
    wide = wide.withColumnsRenamed({m: f"{m}_{suffix}" for m in models})
    extra = {}
    for new, base in contests:
        a, b = F.col(f"{new}_{suffix}"), F.col(f"{base}_{suffix}")
        extra[f"{new}_better_than_{base}"] = a < b
        extra[f"{new}_improvement_vs_{base}"] = b - a
    return wide.withColumns(extra)


def percent_improvement(errors: DataFrame, challenger: str, base: str) -> DataFrame:
    """Percent by which the challenger lowers each ticker's MSE."""
    wide = compare_models(errors, ["ticker"], "mse", [(challenger, base)], "mse")
    old, new = F.col(f"{base}_mse"), F.col(f"{challenger}_mse")
    return wide.withColumn("improvement_pct", F.try_divide(old - new, old) * 100) \
        .orderBy(F.desc("improvement_pct"), "ticker")


def mean_improvement(improvement: DataFrame) -> DataFrame:
    return improvement.agg(F.avg("improvement_pct").alias("mean_improvement_pct"))


def win_counts(comparison: DataFrame, contests: list[tuple[str, str]], scope: str) -> DataFrame:
    """k of n per contest."""
    cells = [F.struct(F.lit(new).alias("challenger"), F.lit(base).alias("base"),
                      F.count_if(F.col(f"{new}_better_than_{base}")).alias("wins"))
             for new, base in contests]
    return comparison.agg(F.count("*").alias("n"), F.array(*cells).alias("cells")) \
        .select(F.lit(scope).alias("scope"), "n", F.explode("cells").alias("c")) \
        .select("scope", "c.challenger", "c.base", "c.wins", "n")


GATE_COLUMNS = ["gate_mean", "gate_min", "gate_max", "gate_std"]


def gate_statistics(forecasts: DataFrame) -> DataFrame:
    """Gate mean, minimum, maximum and population deviation per step and model."""
    return forecasts.groupBy("step", "date", "model").agg(
        F.avg("gate").alias("gate_mean"), F.min("gate").alias("gate_min"),
        F.max("gate").alias("gate_max"), F.stddev_pop("gate").alias("gate_std"))


def mean_gate_statistics(statistics: DataFrame) -> DataFrame:
    return statistics.groupBy("model").agg(*[F.avg(c).alias(c) for c in GATE_COLUMNS])


def stack_forecasts(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def error_matrix(errors: DataFrame, models: list[str]) -> DataFrame:
    """Ticker x model table of MSE for a heat map."""
    return errors.groupBy("ticker").pivot("model", models).agg(F.first("mse"))
