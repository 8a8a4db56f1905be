"""Forecast evaluation queries."""

from __future__ import annotations

from barloom.operators import metrics as M
from barloom.plans import inputs
from barloom.plans.inputs import CONTESTS, MODELS
from barloom.plans.oracle_prefix import BACKTEST_PREFIX
from barloom.plans.registry import query
from barloom.session import stage

METRIC_SPEC = "model mse:f mae:f rmse:f directional_accuracy:f"
METRIC_SQL = """
SELECT model, avg(pow(y_true - y_pred, 2)) AS mse, avg(abs(y_true - y_pred)) AS mae,
    sqrt(avg(pow(y_true - y_pred, 2))) AS rmse,
    avg(CASE WHEN (y_true - last_close > 0) = (y_pred - last_close > 0) THEN 1.0 ELSE 0.0 END)
        AS directional_accuracy FROM fc GROUP BY 1"""


@query("src_forecasts", "model step:i date:d ticker y_true:f y_pred:f last_close:f gate:f",
       BACKTEST_PREFIX, "SELECT * FROM fc")
def forecasts(spark, sf_dir):
    return inputs.forecasts(spark, sf_dir)


@query("agg7_forecast_metrics", METRIC_SPEC, BACKTEST_PREFIX, METRIC_SQL)
def forecast_metrics(spark, sf_dir):
    return M.forecast_metrics(inputs.forecasts(spark, sf_dir), ["model"])


@query("agg8_leaderboard", METRIC_SPEC + " window", BACKTEST_PREFIX,
       f"SELECT *, 'last 20' AS \"window\" FROM ({METRIC_SQL}) m ORDER BY mse")
def leaderboard(spark, sf_dir):
    return M.leaderboard(inputs.forecasts(spark, sf_dir), window="last 20")


@query("agg9_day_mse", "model step:i date:d day_mse:f", BACKTEST_PREFIX, "SELECT * FROM day_mse")
def day_mse(spark, sf_dir):
    return M.day_mse(inputs.forecasts(spark, sf_dir))


def _contest_sql(table: str, keys: str, value: str, suffix: str) -> str:
    cells = ", ".join(f"max(CASE WHEN model = '{m}' THEN {value} END) AS {m}_{suffix}"
                      for m in MODELS)
    extra = ", ".join(
        f"{a}_{suffix} < {b}_{suffix} AS {a}_better_than_{b}, "
        f"{b}_{suffix} - {a}_{suffix} AS {a}_improvement_vs_{b}" for a, b in CONTESTS)
    return f"SELECT *, {extra} FROM (SELECT {keys}, {cells} FROM {table} GROUP BY {keys}) w"


def _contest_spec(suffix: str) -> str:
    return " ".join([f"{m}_{suffix}:f" for m in MODELS]
                    + [f"{a}_better_than_{b} {a}_improvement_vs_{b}:f" for a, b in CONTESTS])


STEP_SQL = _contest_sql("day_mse", "step, date", "day_mse", "day_mse")
TICKER_SQL = _contest_sql("tick_mse", "ticker", "mse", "mse")


@query("jn2_compare_steps", "step:i date:d " + _contest_spec("day_mse"), BACKTEST_PREFIX, STEP_SQL)
def compare_steps(spark, sf_dir):
    return M.compare_models(day_mse(spark, sf_dir), ["step", "date"], "day_mse", CONTESTS,
                            "day_mse")


@query("agg10_symbol_mse", "ticker " + _contest_spec("mse"), BACKTEST_PREFIX, TICKER_SQL)
def symbol_mse(spark, sf_dir):
    errors = M.symbol_mse(inputs.forecasts(spark, sf_dir))
    return M.compare_models(errors, ["ticker"], "mse", CONTESTS, "mse")


PERCENT_SQL = f"""
SELECT ticker, naive_mse, ma20_mse, (naive_mse - ma20_mse) / naive_mse * 100 AS improvement_pct
FROM ({TICKER_SQL}) t"""


@query("agg11_percent_improvement", "ticker naive_mse:f ma20_mse:f improvement_pct:f",
       BACKTEST_PREFIX, PERCENT_SQL)
def percent_improvement(spark, sf_dir):
    return M.percent_improvement(M.symbol_mse(inputs.forecasts(spark, sf_dir)), "ma20", "naive")


@query("agg11_mean_improvement", "mean_improvement_pct:f", BACKTEST_PREFIX,
       f"SELECT avg(improvement_pct) AS mean_improvement_pct FROM ({PERCENT_SQL}) p")
def mean_improvement(spark, sf_dir):
    return M.mean_improvement(percent_improvement(spark, sf_dir))


def _wins_sql(table: str, scope: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{scope}' AS scope, '{a}' AS challenger, '{b}' AS base, "
        f"count(*) FILTER (WHERE {a}_better_than_{b}) AS wins, count(*) AS n FROM ({table}) x"
        for a, b in CONTESTS)


@query("agg12_win_counts", "scope challenger base wins:i n:i", BACKTEST_PREFIX,
       _wins_sql(STEP_SQL, "day") + " UNION ALL " + _wins_sql(TICKER_SQL, "ticker"))
def win_counts(spark, sf_dir):
    rows = stage(inputs.forecasts(spark, sf_dir))
    days = M.compare_models(M.day_mse(rows), ["step", "date"], "day_mse", CONTESTS, "day_mse")
    symbols = M.compare_models(M.symbol_mse(rows), ["ticker"], "mse", CONTESTS, "mse")
    return M.win_counts(days, CONTESTS, "day").unionByName(
        M.win_counts(symbols, CONTESTS, "ticker"))


GATE_SPEC = "gate_mean:f gate_min:f gate_max:f gate_std:f"
GATE_SQL = """
SELECT step, date, model, avg(gate) AS gate_mean, min(gate) AS gate_min, max(gate) AS gate_max,
    stddev_pop(gate) AS gate_std FROM fc GROUP BY 1, 2, 3"""


@query("agg13_gate_statistics", "step:i date:d model " + GATE_SPEC, BACKTEST_PREFIX, GATE_SQL)
def gate_statistics(spark, sf_dir):
    return M.gate_statistics(inputs.forecasts(spark, sf_dir))


@query("agg14_mean_gate", "model " + GATE_SPEC, BACKTEST_PREFIX, f"""
SELECT model, avg(gate_mean) AS gate_mean, avg(gate_min) AS gate_min, avg(gate_max) AS gate_max,
    avg(gate_std) AS gate_std FROM ({GATE_SQL}) g GROUP BY 1""")
def mean_gate(spark, sf_dir):
    return M.mean_gate_statistics(gate_statistics(spark, sf_dir))


@query("prj13_error_matrix", "ticker naive:f ma5:f ma20:f", BACKTEST_PREFIX,
       "SELECT ticker, " + ", ".join(
           f"max(CASE WHEN model = '{m}' THEN mse END) AS {m}" for m in MODELS)
       + " FROM tick_mse GROUP BY 1")
def error_matrix(spark, sf_dir):
    return M.error_matrix(M.symbol_mse(inputs.forecasts(spark, sf_dir)), MODELS)
