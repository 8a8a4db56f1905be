"""No look-ahead, split boundaries, and invariants that hold for any input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.config import BacktestConfig, GraphConfig
from barloom.operators import bars as B
from barloom.operators import calendar as C
from barloom.operators import features as X
from barloom.operators import graph as G
from barloom.operators import samples as S
from barloom.operators import scaling as Z
from barloom.operators import ticks as K
from barloom.operators.pairs import pair_statistics
from tests.panels import bars, correlated, panel

CONFIG = BacktestConfig(lookback=4, test_days=6, initial_train=50, val_days=8)


def rows(df):
    return sorted(map(repr, df.collect()))


def test_future_bars_do_not_change_the_past(spark):
    rng = np.random.default_rng(2)
    closes = {s: list(100 + rng.normal(size=60).cumsum()) for s in "AB"}
    early = X.engineer_features(bars(spark, {s: v[:45] for s, v in closes.items()}))
    later = X.engineer_features(bars(spark, closes))
    cut = early.agg(F.max("date")).first()[0]
    assert rows(early) == rows(later.filter(F.col("date") <= F.lit(cut)))


def test_future_returns_do_not_change_a_graph_or_a_sample(spark):
    returns = correlated(80, 5, seed=9)
    names = list("ABCDE")
    changed = returns.copy()
    changed[70:] *= -3
    plan = S.StepPlan(66, 5, 10)
    config = GraphConfig(recent_days=30, pearson_threshold=0.1, lift_threshold=1.0)
    before = panel(spark, returns, names)
    after = panel(spark, changed, names)
    symbols = before.select("symbol").distinct()
    # Step 5 tests t = 70, so its window ends at t = 69, before the change.
    assert rows(G.build_graph(before, symbols, plan, config)) == \
        rows(G.build_graph(after, symbols, plan, config))
    columns = ["close", "ret"]
    assert rows(S.build_samples(before, 4, columns).filter("t < 70")) == \
        rows(S.build_samples(after, 4, columns).filter("t < 70"))


def test_no_training_sample_reaches_the_test_date(spark):
    frame = panel(spark, correlated(70, 3), list("ABC"))
    calendar = C.trading_calendar(frame)
    plan = S.plan_steps(calendar, CONFIG)
    keys = S.build_samples(frame, CONFIG.lookback, ["close", "ret"]).select("t", "symbol")
    split = S.split_samples(keys, plan.frame(spark), CONFIG).cache()
    assert split.filter("split <> 'test' and t >= test_t").isEmpty()
    counts = split.groupBy("step", "split").agg(F.count_distinct("t").alias("n")).collect()
    got = {(r.step, r.split): r.n for r in counts}
    for step in range(1, 7):
        assert got[(step, "test")] == 1 and got[(step, "val")] == CONFIG.val_days
        assert got[(step, "train")] == 50 - CONFIG.lookback + step - 1 - CONFIG.val_days


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_graph_invariants(spark, seed):
    returns = correlated(60, 11, seed=seed, noise=2.0)
    frame = panel(spark, returns, [f"S{k:02d}" for k in range(11)])
    config = GraphConfig(recent_days=60, pearson_threshold=0.05, lift_threshold=1.0)
    plan = G.snapshot_plan(60, 60)
    parts = G.graph_parts(pair_statistics(frame, plan, 60, config), config)
    edges = G.with_self_edges(parts["combined"], frame.select("symbol").distinct(), 1).collect()
    weight = {(e.src, e.dst): e.weight for e in edges}
    assert len(weight) == len(edges)
    assert all(weight[(b, a)] == w for (a, b), w in weight.items())
    assert all(weight[(f"S{k:02d}",) * 2] == 1.0 for k in range(11))
    assert all(0 < w <= 1 + 1e-12 for w in weight.values())


def test_minmax_inverse(spark):
    frame = panel(spark, correlated(40, 3, seed=4), list("ABC"))
    params = Z.fit_minmax(frame, 0, 29, ["close"])
    scaled = Z.apply_minmax(frame, params, ["close"])
    back = scaled.join(Z.close_range(params), "symbol").withColumn(
        "close", Z.inverse_close(F.col("close"), F.col("close_min"), F.col("close_max")))
    diff = back.join(frame.select("t", "symbol", F.col("close").alias("want")), ["t", "symbol"])
    assert diff.filter("abs(close - want) > 1e-9").isEmpty()
    inside = scaled.filter("t <= 29").agg(F.min("close"), F.max("close")).first()
    assert inside[0] == pytest.approx(0) and inside[1] == pytest.approx(1)


def test_constant_column_scales_by_one(spark):
    frame = panel(spark, np.zeros((10, 1)), ["A"], np.full((10, 1), 5.0))
    params = Z.fit_minmax(frame, 0, 5, ["close"])
    assert {r.close for r in Z.apply_minmax(frame, params, ["close"]).collect()} == {0.0}


def test_aligned_panel_is_rectangular(spark):
    rng = np.random.default_rng(8)
    days = {s: sorted(rng.choice(80, 60, replace=False).tolist()) for s in "ABC"}
    frame = X.engineer_features(bars(
        spark, {s: list(1 + rng.random(60)) for s in "ABC"}, days))
    aligned, calendar = C.aligned_panel(frame)
    n = calendar.count()
    assert n > 0 and aligned.count() == 3 * n
    assert aligned.groupBy("symbol").count().filter(f"count <> {n}").isEmpty()


@pytest.mark.parametrize("policy", ["overwrite_last", "ignore"])
def test_merge_against_plain_python(spark, policy):
    import datetime as dt
    rng = np.random.default_rng(11)
    symbols = [f"S{k:02d}" for k in range(40)]
    days = {s: sorted(rng.choice(12, rng.integers(1, 8), replace=False).tolist())
            for s in symbols}
    frame = bars(spark, {s: list(rng.random(len(days[s]))) for s in symbols}, days)
    # One symbol holds a third of all ticks; some symbols have none.
    owners = ["S00"] * 100 + list(rng.choice(symbols[:30], 200))
    rows = [(s, float(k), k % 3, int(rng.integers(0, 50)),
             dt.datetime(2024, 1, 1) + dt.timedelta(days=int(rng.integers(0, 16))))
            for k, s in enumerate(owners)]
    ticks = spark.createDataFrame(rows, "symbol string, price double, partition_id int, "
                                        "kafka_offset long, event_time timestamp")
    newest = {}
    for row in rows:
        order = (row[4], row[3], row[2], row[1])
        if row[0] not in newest or order > newest[row[0]][0]:
            newest[row[0]] = (order, row)
    want = {(r.symbol, r.date): r.close for r in frame.collect()}
    for s, (_, row) in newest.items():
        date = row[4].date()
        last = max(d for (n, d) in want if n == s)
        if (s, date) in want or date > last:
            want[(s, date)] = row[1]
        elif policy == "overwrite_last":
            want[(s, last)] = row[1]
    got = B.merge_ticks(frame, K.latest_ticks(ticks), policy).collect()
    assert len(got) == len(want)
    assert {(r.symbol, r.date): r.close for r in got} == want
