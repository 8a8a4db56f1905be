"""Queries over bars, features, alignment, samples and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import bars as B
from barloom.operators import calendar as C
from barloom.operators import features as X
from barloom.operators import samples as S
from barloom.operators import scaling as Z
from barloom.plans import inputs
from barloom.plans.inputs import BACKTEST
from barloom.plans.oracle_prefix import BACKTEST_PREFIX, BAR_PREFIX, BARS, FEATURES
from barloom.plans.registry import query
from barloom.session import stage

BAR_SPEC = "symbol date:d open:f high:f low:f close:f volume:f"
FEATURE_SPEC = BAR_SPEC + " ret:f ma5:f ma20:f vol5:f vol20:f"
BRAND_PREFIX = ",".join([BARS, FEATURES.format(name="bfeat", bars="bars_brand")])
FILLED = """
filled AS (SELECT symbol, date, open, high, low, volume,
    last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close FROM gapped)"""
GAP_PREFIX = ",".join([BARS, FILLED])
SYMBOLS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("src_daily_bars", BAR_SPEC, BARS, "SELECT * FROM bars_day")
def daily_bars(spark, sf_dir):
    return inputs.bars_day(spark, sf_dir)


@query("win1_forward_fill", "symbol date:d close:f", GAP_PREFIX, "SELECT * FROM filled")
def forward_fill(spark, sf_dir):
    return B.forward_fill(inputs.gapped_bars(spark, sf_dir), ["close"])


@query("prj4_clean_bars", BAR_SPEC, GAP_PREFIX, """
SELECT symbol, date, coalesce(open, close) AS open, coalesce(high, close) AS high,
    coalesce(low, close) AS low, close, coalesce(volume, 0.0) AS volume
FROM filled WHERE close IS NOT NULL""")
def clean_bars(spark, sf_dir):
    return B.clean_bars(inputs.gapped_bars(spark, sf_dir))


@query("win2_returns", "symbol date:d ret:f", BAR_PREFIX, "SELECT * FROM feat_all")
def returns(spark, sf_dir):
    return inputs.bars_day(spark, sf_dir).withColumn("ret", X.simple_return())


@query("win3_moving_averages", "symbol date:d ma5:f ma20:f", BAR_PREFIX, "SELECT * FROM feat_all")
def moving_averages(spark, sf_dir):
    return inputs.bars_day(spark, sf_dir).withColumns(
        {"ma5": X.rolling("close", 5), "ma20": X.rolling("close", 20)})


@query("win4_volatility", "symbol date:d vol5:f vol20:f", BAR_PREFIX, "SELECT * FROM feat_all")
def volatility(spark, sf_dir):
    return X.add_features(inputs.bars_day(spark, sf_dir))


@query("flt2_warm_up_rows", "symbol n_all:i n_kept:i", BAR_PREFIX, """
SELECT a.symbol, count(*) AS n_all, count(f.date) AS n_kept FROM feat_all a
LEFT JOIN feat f ON a.symbol = f.symbol AND a.date = f.date GROUP BY 1""")
def warm_up_rows(spark, sf_dir):
    rows = X.add_features(inputs.bars_day(spark, sf_dir))
    complete = F.lit(True)
    for name in rows.columns:
        complete = complete & F.col(name).isNotNull()
    return rows.groupBy("symbol").agg(F.count("*").alias("n_all"),
                                      F.count_if(complete).alias("n_kept"))


@query("win5_features", FEATURE_SPEC, BAR_PREFIX, "SELECT * FROM feat")
def features(spark, sf_dir):
    return X.engineer_features(inputs.bars_day(spark, sf_dir))


@query("win5_brand_features", FEATURE_SPEC, BRAND_PREFIX, "SELECT * FROM bfeat")
def brand_features(spark, sf_dir):
    return X.engineer_features(inputs.bars_brand_day(spark, sf_dir))


@query("win6_paper_features", BAR_SPEC + " ret:f", BARS + """,
pfill AS (SELECT symbol, date,
    last_value(open IGNORE NULLS) OVER w AS open, last_value(high IGNORE NULLS) OVER w AS high,
    last_value(low IGNORE NULLS) OVER w AS low, last_value(close IGNORE NULLS) OVER w AS close,
    last_value(volume IGNORE NULLS) OVER w AS volume FROM gapped
    WINDOW w AS (PARTITION BY symbol ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pret AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1
    AS raw_ret FROM pfill)""", """
SELECT symbol, date, coalesce(open, 0.0) AS open, coalesce(high, 0.0) AS high,
    coalesce(low, 0.0) AS low, coalesce(close, 0.0) AS close, coalesce(volume, 0.0) AS volume,
    coalesce(last_value(raw_ret IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS ret FROM pret""")
def paper_features(spark, sf_dir):
    return X.paper_features(inputs.gapped_bars(spark, sf_dir))


@query("set1_common_dates", "date:d", BAR_PREFIX, "SELECT date FROM panel_cal")
def common_dates(spark, sf_dir):
    return C.common_dates(stage(X.engineer_features(inputs.bars_day(spark, sf_dir))))


@query("win7_dense_index", "date:d t:i", BAR_PREFIX, "SELECT date, t FROM panel_cal")
def dense_index(spark, sf_dir):
    return C.trading_calendar(stage(X.engineer_features(inputs.bars_day(spark, sf_dir))))


@query("jn5_aligned_panel", FEATURE_SPEC + " t:i", BAR_PREFIX, "SELECT * FROM panel")
def aligned_rows(spark, sf_dir):
    return inputs.day_panel(spark, sf_dir)[0]


@query("set2_concatenated_bars", "grain " + BAR_SPEC, BARS, """
SELECT 'day' AS grain, * FROM bars_day UNION ALL SELECT 'month', * FROM bars_month""")
def concatenated(spark, sf_dir):
    day = inputs.bars_day(spark, sf_dir).withColumn("grain", F.lit("day"))
    return day.unionByName(inputs.bars_month(spark, sf_dir).withColumn("grain", F.lit("month")))


@query("prj13_wide_closes", "date:d s1:f s2:f s3:f s4:f s5:f", BAR_PREFIX,
       "SELECT date, " + ", ".join(
           f"max(CASE WHEN symbol = '{s}' THEN close END) AS s{k}"
           for k, s in enumerate(SYMBOLS, 1)) + " FROM panel GROUP BY date")
def wide_closes(spark, sf_dir):
    wide = C.to_wide(inputs.day_panel(spark, sf_dir)[0], SYMBOLS)
    return wide.withColumnsRenamed({s: f"s{k}" for k, s in enumerate(SYMBOLS, 1)})


@query("prj13_long_closes", "date:d symbol close:f", BAR_PREFIX,
       "SELECT date, symbol, close FROM panel")
def long_closes(spark, sf_dir):
    return C.to_long(C.to_wide(inputs.day_panel(spark, sf_dir)[0], SYMBOLS), SYMBOLS)


@query("flt5_window_slice", "t:i symbol close:f", BACKTEST_PREFIX, """
SELECT t, symbol, close FROM panel, dims WHERE t BETWEEN train_start AND first_test - 1""")
def window_slice(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_steps(calendar, BACKTEST)
    return S.slice_range(panel, plan.train_start, plan.initial_end)


@query("flt6_first_test_dates", "date:d t:i", BAR_PREFIX, """
SELECT date, t FROM panel_cal WHERE date >= DATE '1999-06-01' ORDER BY date LIMIT 20""")
def first_test_dates(spark, sf_dir):
    return C.first_dates_from(inputs.day_panel(spark, sf_dir)[1], "1999-06-01", 20)


@query("win13_step_plan", "step:i test_t:i test_date:d train_start:i train_end:i",
       BACKTEST_PREFIX, "SELECT * FROM steps")
def step_plan(spark, sf_dir):
    _, calendar = inputs.day_panel(spark, sf_dir)
    return S.dated_steps(S.plan_steps(calendar, BACKTEST), calendar)


@query("jn8_step_windows", "step:i n_rows:i first_t:i last_t:i sum_ret:f", BACKTEST_PREFIX, """
SELECT s.step, count(*) AS n_rows, min(t) AS first_t, max(t) AS last_t, sum(ret) AS sum_ret
FROM panel p JOIN steps s ON p.t BETWEEN s.train_start AND s.train_end GROUP BY 1""")
def step_windows(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    steps = S.plan_steps(calendar, BACKTEST).frame(spark)
    daily = panel.groupBy("t").agg(F.count("*").alias("n"), F.sum("ret").alias("ret"))
    return S.rows_in_windows(daily, steps, "train_start", "train_end").groupBy("step").agg(
        F.sum("n").alias("n_rows"), F.min("t").alias("first_t"), F.max("t").alias("last_t"),
        F.sum("ret").alias("sum_ret"))


@query("win8_training_sequences", "t:i symbol lag:i close:f", BACKTEST_PREFIX, """
SELECT a.t, a.symbol, a.t - b.t AS lag, b.close FROM panel a
JOIN panel b ON a.symbol = b.symbol AND b.t BETWEEN a.t - 20 AND a.t - 1 WHERE a.t >= 20""")
def training_sequences(spark, sf_dir):
    samples = S.build_samples(inputs.day_panel(spark, sf_dir)[0], BACKTEST.lookback)
    return samples.select("t", "symbol", F.posexplode("seq").alias("pos", "close")) \
        .withColumn("lag", BACKTEST.lookback - F.col("pos"))


@query("win8_serving_sequences", "t:i symbol lag:i close:f", BACKTEST_PREFIX, """
SELECT a.t, a.symbol, a.t - b.t AS lag, b.close FROM panel a
JOIN panel b ON a.symbol = b.symbol AND b.t BETWEEN a.t - 19 AND a.t WHERE a.t >= 19""")
def serving_sequences(spark, sf_dir):
    rows = S.serving_sequences(inputs.day_panel(spark, sf_dir)[0], BACKTEST.lookback)
    return rows.select("t", "symbol", F.posexplode("seq").alias("pos", "close")) \
        .withColumn("lag", BACKTEST.lookback - 1 - F.col("pos"))


SAMPLE_SPEC = ("t:i date:d symbol last_close:f target:f residual:f node_volume:f node_ret:f "
               "node_ma5:f node_ma20:f node_vol5:f node_vol20:f")


def _flat_samples(panel):
    """Sample rows with the node vector as columns."""
    samples = S.build_samples(panel, BACKTEST.lookback)
    names = ["volume", "ret", "ma5", "ma20", "vol5", "vol20"]
    return samples.withColumns({f"node_{n}": F.get("node", F.lit(k))
                                for k, n in enumerate(names, start=1)})


@query("win9_sample_targets", SAMPLE_SPEC, BACKTEST_PREFIX, "SELECT * FROM samples WHERE t >= 20")
def sample_targets(spark, sf_dir):
    return _flat_samples(inputs.day_panel(spark, sf_dir)[0])


@query("bt1_sample_range", SAMPLE_SPEC, BACKTEST_PREFIX, """
SELECT s.* FROM samples s, dims d WHERE s.t >= 20
    AND s.t BETWEEN d.train_start + 20 AND d.first_test - 1""")
def sample_range(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_steps(calendar, BACKTEST)
    return S.sample_range(_flat_samples(panel), plan.train_start + BACKTEST.lookback,
                          plan.initial_end)


SPLIT_SQL = """
SELECT s.step, CASE WHEN k.t = s.test_t THEN 'test'
    WHEN row_number() OVER (PARTITION BY s.step, k.symbol ORDER BY k.t DESC) <= 21 THEN 'val'
    ELSE 'train' END AS split, k.t, k.symbol, k.residual
FROM samples k JOIN steps s ON k.t BETWEEN s.train_start + 20 AND s.test_t WHERE k.t >= 20"""


@query("bt2_split_rows", "step:i split t:i symbol residual:f", BACKTEST_PREFIX, SPLIT_SQL)
def split_rows(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    steps = S.plan_steps(calendar, BACKTEST).frame(spark)
    keys = S.build_samples(panel, BACKTEST.lookback).select("t", "symbol", "residual")
    return S.split_samples(keys, steps, BACKTEST)


@query("win14_split_counts", "step:i split n_rows:i first_t:i last_t:i", BACKTEST_PREFIX, f"""
SELECT step, split, count(*) AS n_rows, min(t) AS first_t, max(t) AS last_t
FROM ({SPLIT_SQL}) x GROUP BY 1, 2""")
def split_counts(spark, sf_dir):
    return split_rows(spark, sf_dir).groupBy("step", "split").agg(
        F.count("*").alias("n_rows"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


@query("win15_latest_split", "split n_rows:i first_t:i last_t:i", BACKTEST_PREFIX, """
SELECT CASE WHEN t = last THEN 'test' WHEN t >= last - 20 THEN 'val' ELSE 'train' END AS split,
    count(*) AS n_rows, min(t) AS first_t, max(t) AS last_t
FROM (SELECT t, max(t) OVER () AS last FROM samples WHERE t >= 20) x GROUP BY 1""")
def latest_split(spark, sf_dir):
    samples = S.build_samples(inputs.day_panel(spark, sf_dir)[0], BACKTEST.lookback)
    return S.latest_split(samples, BACKTEST.val_days).groupBy("split").agg(
        F.count("*").alias("n_rows"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


MINMAX_SPEC = "symbol close_min:f close_max:f volume_min:f volume_max:f ma20_min:f ma20_max:f"
SCALED_COLUMNS = X.FEATURE_COLUMNS


@query("agg20_minmax_fit", MINMAX_SPEC, BACKTEST_PREFIX, """
SELECT symbol, min(close) AS close_min, max(close) AS close_max, min(volume) AS volume_min,
    max(volume) AS volume_max, min(ma20) AS ma20_min, max(ma20) AS ma20_max
FROM panel, dims WHERE t BETWEEN train_start AND first_test - 1 GROUP BY 1""")
def minmax_fit(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_steps(calendar, BACKTEST)
    return Z.fit_minmax(panel, plan.train_start, plan.initial_end, SCALED_COLUMNS)


def _unit_sql(c: str) -> str:
    return (f"({c} - {c}_min) / CASE WHEN {c}_max <> {c}_min THEN {c}_max - {c}_min ELSE 1 END "
            f"AS {c}")


@query("agg20_minmax_scaled", "t:i symbol " + " ".join(f"{c}:f" for c in SCALED_COLUMNS),
       BACKTEST_PREFIX, "SELECT t, p.symbol, " + ", ".join(map(_unit_sql, SCALED_COLUMNS))
       + " FROM panel p JOIN (SELECT symbol, " + ", ".join(
           f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in SCALED_COLUMNS)
       + " FROM panel, dims WHERE t BETWEEN train_start AND first_test - 1 GROUP BY 1) r"
         " ON p.symbol = r.symbol")
def minmax_scaled(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_steps(calendar, BACKTEST)
    return inputs.scaled_panel(panel, plan, SCALED_COLUMNS)


@query("agg23_close_range", "symbol close_min:f close_max:f", BACKTEST_PREFIX,
       "SELECT * FROM close_range")
def close_range(spark, sf_dir):
    return Z.close_range(minmax_fit(spark, sf_dir))


STANDARD_COLUMNS = ["close", "volume"]


@query("agg21_standard_fit", "step:i close_mean:f close_std:f volume_mean:f volume_std:f",
       BACKTEST_PREFIX, """
SELECT s.step, avg(close) AS close_mean, stddev_pop(close) AS close_std,
    avg(volume) AS volume_mean, stddev_pop(volume) AS volume_std
FROM panel p JOIN steps s ON p.t BETWEEN s.train_start AND s.train_end GROUP BY 1""")
def standard_fit(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    steps = S.plan_steps(calendar, BACKTEST).frame(spark)
    return Z.fit_standard(panel, steps, STANDARD_COLUMNS)


@query("agg21_standard_scaled", "step:i t:i symbol close:f volume:f", BACKTEST_PREFIX, """
SELECT s.step, p.t, p.symbol, (p.close - f.cm) / CASE WHEN f.cs <> 0 THEN f.cs ELSE 1 END AS close,
    (p.volume - f.vm) / CASE WHEN f.vs <> 0 THEN f.vs ELSE 1 END AS volume
FROM panel p JOIN steps s ON p.t BETWEEN s.train_start AND s.test_t JOIN (
    SELECT s.step, avg(close) AS cm, stddev_pop(close) AS cs, avg(volume) AS vm,
        stddev_pop(volume) AS vs FROM panel p JOIN steps s
        ON p.t BETWEEN s.train_start AND s.train_end GROUP BY 1) f ON s.step = f.step""")
def standard_scaled(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    steps = S.plan_steps(calendar, BACKTEST).frame(spark)
    rows = panel.select("t", "symbol", "close", "volume")
    params = Z.fit_standard(rows, steps, STANDARD_COLUMNS)
    return Z.apply_standard(rows, params, steps, STANDARD_COLUMNS)


@query("bt10_forward_plan", "step:i test_t:i test_date:d train_start:i train_end:i", BAR_PREFIX, """
SELECT row_number() OVER (ORDER BY date) AS step, t AS test_t, date AS test_date,
    greatest(0, min(t) OVER () - 200) AS train_start, t - 1 AS train_end
FROM (SELECT date, t FROM panel_cal WHERE date >= DATE '1999-06-01' ORDER BY date LIMIT 20) x""")
def forward_plan(spark, sf_dir):
    _, calendar = inputs.day_panel(spark, sf_dir)
    return S.dated_steps(S.plan_forward(calendar, "1999-06-01", BACKTEST), calendar)


@query("bt10_forward_scaled", "t:i symbol close:f", BAR_PREFIX + """,
fdims AS (SELECT min(t) AS first_test, greatest(0, min(t) - 200) AS train_start FROM panel_cal
    WHERE date >= DATE '1999-06-01'),
frange AS (SELECT symbol, min(close) AS lo, max(close) AS hi FROM panel, fdims
    WHERE t BETWEEN train_start AND first_test - 1 GROUP BY 1)""", """
SELECT t, p.symbol, (close - lo) / CASE WHEN hi <> lo THEN hi - lo ELSE 1 END AS close
FROM panel p JOIN frange r ON p.symbol = r.symbol""")
def forward_scaled(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_forward(calendar, "1999-06-01", BACKTEST)
    return inputs.scaled_panel(panel, plan, ["close"])
