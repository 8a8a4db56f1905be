"""Hand-worked results on tiny inputs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.config import BacktestConfig, GraphConfig
from barloom.functions import scalars as P
from barloom.guards import DataCheckError, require_daily_key
from barloom.operators import bars as B
from barloom.operators import calendar as C
from barloom.operators import features as X
from barloom.operators import graph as G
from barloom.operators import samples as S
from barloom.operators import serving as V
from barloom.operators import ticks as K
from barloom.operators.pairs import pair_statistics
from tests.panels import bars, day, panel


def test_tiny_bars_features(spark):
    closes = [float(k) for k in range(1, 26)]
    closes[6] = None
    rows = X.engineer_features(B.clean_bars(bars(spark, {"A": closes}))).orderBy("date").collect()
    assert [r.date for r in rows] == [day(k) for k in range(19, 25)]
    filled = [float(k) for k in range(1, 26)]
    filled[6] = 6.0
    returns = [0.0] + [b / a - 1 for a, b in zip(filled, filled[1:])]
    for k, r in zip(range(19, 25), rows):
        assert r.ret == pytest.approx(returns[k])
        assert r.ma5 == pytest.approx(np.mean(filled[k - 4:k + 1]))
        assert r.ma20 == pytest.approx(np.mean(filled[k - 19:k + 1]))
        assert r.vol5 == pytest.approx(np.std(returns[k - 4:k + 1], ddof=1))
        assert r.vol20 == pytest.approx(np.std(returns[k - 19:k + 1], ddof=1))


def test_warm_up_that_leaves_nothing_is_refused(spark):
    with pytest.raises(DataCheckError):
        X.engineer_features(bars(spark, {"A": [1.0] * 19}), check=True)


def test_zero_close_gives_null_return(spark):
    rows = bars(spark, {"A": [1.0, 0.0, 2.0]}).withColumn("ret", X.simple_return())
    assert [r.ret for r in rows.orderBy("date").collect()] == [0.0, -1.0, None]


def test_clean_bars_defaults(spark):
    raw = spark.createDataFrame(
        [("A", day(0), None, None, None, None, None), ("A", day(1), None, 3.0, None, 2.0, None),
         ("A", day(2), 5.0, float("nan"), 1.0, None, 4.0)],
        "symbol string, date date, open double, high double, low double, close double, "
        "volume double")
    rows = B.clean_bars(raw).orderBy("date").collect()
    assert [tuple(r)[2:] for r in rows] == [(2.0, 3.0, 2.0, 2.0, 0.0), (5.0, 2.0, 1.0, 2.0, 4.0)]


def test_daily_key_guard(spark):
    good = bars(spark, {"A": [1.0, 2.0]})
    assert require_daily_key(good) is good
    with pytest.raises(DataCheckError, match="several bars for A"):
        require_daily_key(good.unionByName(good))


def test_features_refuse_repeated_days(spark):
    once = bars(spark, {"A": [1.0, 2.0], "B": [1.0]})
    twice = once.unionByName(once.filter("symbol = 'A'").limit(1))
    with pytest.raises(Exception, match="several bars for A"):
        X.add_features(twice).collect()


def test_ragged_panel_intersection(spark):
    frame = bars(spark, {"A": [1.0] * 4, "B": [2.0] * 3, "C": [3.0] * 3},
                 {"A": [0, 1, 2, 3], "B": [0, 2, 3], "C": [1, 2, 3]})
    calendar = C.trading_calendar(frame)
    assert [(r.date, r.t) for r in calendar.orderBy("t").collect()] == [(day(2), 0), (day(3), 1)]
    assert C.align(frame, calendar).count() == 6


def test_first_dates_guard(spark):
    calendar = C.trading_calendar(bars(spark, {"A": [1.0] * 5}))
    assert [r.t for r in C.first_dates_from(calendar, "2024-01-03", 2).collect()] == [2, 3]
    with pytest.raises(DataCheckError):
        C.first_dates_from(calendar, "2024-01-03", 4)


TICK = "symbol string, price double, partition_id int, kafka_offset long, event_time timestamp"


def at(k, hour=12):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=k)


def test_latest_tick_order(spark):
    ticks = spark.createDataFrame([
        ("A", 1.0, 0, 5, at(1)), ("A", 2.0, 1, 7, at(1)), ("A", 3.0, 0, 9, at(0)),
        ("B", 4.0, 0, None, at(1)), ("B", 5.0, 0, 0, at(1)),
        ("C", 6.0, 0, 3, at(1)), ("C", 7.0, 2, 3, at(1)),
        ("D", None, 0, 1, at(1)), (None, 1.0, 0, 1, at(1)), ("E", 1.0, 0, 1, None)], TICK)
    got = {r.symbol: r.price for r in K.latest_ticks(ticks).collect()}
    assert got == {"A": 2.0, "B": 5.0, "C": 7.0}


def test_three_merge_branches(spark):
    history = bars(spark, {s: [1.0, 2.0, 3.0] for s in "ABCDE"}, {s: [0, 2, 3] for s in "ABCDE"})
    ticks = spark.createDataFrame([
        ("A", 9.0, 0, 1, at(3)), ("B", 9.0, 0, 1, at(5)), ("C", 9.0, 0, 1, at(1)),
        ("D", 9.0, 0, 1, at(2))], TICK)
    rows = B.merge_ticks(history, ticks).orderBy("symbol", "date").collect()
    got = {s: [(r.date, r.close, r.volume) for r in rows if r.symbol == s] for s in "ABCDE"}
    assert got["A"] == [(day(0), 1.0, 10.0), (day(2), 2.0, 10.0), (day(3), 9.0, 10.0)]
    assert got["B"] == [(day(0), 1.0, 10.0), (day(2), 2.0, 10.0), (day(3), 3.0, 10.0),
                        (day(5), 9.0, 10.0)]
    assert got["C"] == [(day(0), 1.0, 10.0), (day(2), 2.0, 10.0), (day(3), 9.0, 10.0)]
    assert got["D"] == [(day(0), 1.0, 10.0), (day(2), 9.0, 10.0), (day(3), 3.0, 10.0)]
    assert got["E"] == [(day(0), 1.0, 10.0), (day(2), 2.0, 10.0), (day(3), 3.0, 10.0)]
    ignored = B.merge_ticks(history, ticks, "ignore").filter("symbol = 'C'").orderBy("date")
    assert [r.close for r in ignored.collect()] == [1.0, 2.0, 3.0]


def message(body, offset=0):
    return (b"k", body.encode(), "stock-price", 0, offset, at(0))


def test_parse_dirty_messages(spark):
    raw = spark.createDataFrame([
        message('{"symbol": "A", "price": 1.5, "source": "x"}', 0), message("not json", 1),
        message('{"symbol": "B", "price": "2.5"}', 2), message('{"price": 3.5}', 3),
        message('{"symbol": "C", "price": 4}', 4)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    parsed = K.parse_payload(K.decode_messages(raw)).orderBy("kafka_offset").collect()
    assert [(r.symbol, r.price) for r in parsed] == [
        ("A", 1.5), (None, None), ("B", None), (None, 3.5), ("C", 4.0)]
    assert [r.symbol for r in K.parse_ticks(raw).orderBy("kafka_offset").collect()] == ["A", "C"]


def test_payload_time(spark):
    raw = spark.createDataFrame([
        message('{"symbol": "A", "price": 1.5, "event_time": "2024-02-03T04:05:06+00:00"}')],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    row = K.parse_ticks(raw, "payload").select(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    assert row.first()[0] == "2024-02-03 04:05:06"


def test_constant_series_has_zero_correlation(spark):
    returns = np.column_stack([np.full(30, 0.1), np.linspace(-1, 1, 30), np.linspace(-2, 2, 30)])
    stats = pair_statistics(panel(spark, returns, ["A", "B", "C"]), G.snapshot_plan(30, 30), 30)
    got = {(r.a, r.b): r["corr"] for r in stats.collect()}
    assert got[("A", "B")] == 0.0 and got[("A", "C")] == 0.0
    assert got[("B", "C")] == pytest.approx(1.0)


def test_topk_ties_go_to_later_symbols(spark):
    names = "ABCD"
    edges = spark.createDataFrame([(1, a, b, 0.5) for a in names for b in names if a != b],
                                  "step int, src string, dst string, weight double")
    got = {(r.src, r.dst) for r in G.keep_topk(edges, 1).collect()}
    # A, B and C choose D; D chooses C.
    assert got == {("A", "D"), ("B", "D"), ("C", "D"), ("D", "A"), ("D", "B"), ("D", "C")}


def test_association_measures_are_maximised_apart(spark):
    # Up together on day 1 of 4; down together on days 2 and 3; days 4: A up, B down.
    returns = np.array([[1.0, 1.0], [-1.0, -1.0], [-1.0, -1.0], [1.0, -1.0]])
    stats = pair_statistics(panel(spark, returns, ["A", "B"], np.ones((4, 2))),
                            G.snapshot_plan(4, 4), 4)
    rules = {(r.src, r.dst): r for r in G.association_rules(G.both_directions(stats)).collect()}
    ab, ba = rules[("A", "B")], rules[("B", "A")]
    assert ab.support == pytest.approx(0.5) and ba.support == pytest.approx(0.5)
    assert ab.confidence == pytest.approx(1.0)  # down: 0.5 / 0.5
    assert ba.confidence == pytest.approx(1.0)  # up: 0.25 / 0.25
    assert ab.lift == pytest.approx(2.0)        # up: 0.25 / (0.5 * 0.25)


def test_normalised_weights(spark):
    edges = spark.createDataFrame([(1, "A", "B", 0.5), (1, "B", "A", 0.5)],
                                  "step int, src string, dst string, weight double")
    symbols = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    got = {(r.src, r.dst): r.norm_weight
           for r in G.normalise(G.with_self_edges(edges, symbols, 1)).collect()}
    assert got[("A", "B")] == pytest.approx(0.5 / 1.5)
    assert got[("A", "A")] == pytest.approx(1 / 1.5)
    assert got[("C", "C")] == pytest.approx(1.0)


PREDICTION = ("prediction_run_id string, as_of_date date, model_name string, ticker string, "
              "last_close double, pred_close double, pred_return double, graph_gate double, "
              "created_at timestamp")


@pytest.fixture(scope="module")
def edge_run(spark):
    rows = [("A", 0.0, 1.0, None, 0.3), ("B", 2.0, 1.0, -0.5, 0.6), ("C", -2.0, 1.0, 1.5, None),
            ("D", 1.0, 1.0, 0.0, 0.61)]
    return spark.createDataFrame(
        [("r1", day(0), "m", t, last, pred, ret, gate, at(0)) for t, last, pred, ret, gate in rows],
        PREDICTION)


def test_null_and_boundary_rules(edge_run):
    rows = {r.ticker: r for r in edge_run.select(
        "ticker", P.confidence_tier().alias("tier"), P.predicted_return().alias("ret"),
        P.percent_text("pred_return").alias("pct"),
        P.signed_text(P.price_change(), 2).alias("change")).collect()}
    assert [rows[t].tier for t in "ABCD"] == ["Medium", "Medium", "Low", "High"]
    assert [rows[t].ret for t in "ABCD"] == [None, -0.5, 1.5, 0.0]
    assert [rows[t].pct for t in "ABCD"] == ["—", "-50.0000%", "150.0000%", "0.0000%"]
    assert [rows[t].change for t in "ABCD"] == ["+1.00", "-1.00", "+3.00", "0.00"]


def test_kpis_count_unknown_as_win(edge_run):
    k = V.run_kpis(edge_run).first()
    assert k.win_rate == 75.0
    assert k.win_rate_known == pytest.approx(200 / 3)
    assert k.mean_gate == pytest.approx((0.3 + 0.6 + 0.61) / 4)
    assert (k.max_return, k.min_return) == (1.5, -0.5)


def test_extremes_are_clamped_at_zero(edge_run):
    losing = V.run_kpis(edge_run.filter("pred_return < 0")).first()
    assert (losing.max_return, losing.min_return) == (0.0, -0.5)


def test_tiers_keep_empty_rows(edge_run):
    only_low = V.tier_counts(edge_run.filter("ticker = 'C'")).collect()
    assert {r.tier: r.n for r in only_low} == {"High": 0, "Medium": 0, "Low": 1}


def test_movers(edge_run):
    known = {r.side: r.ticker for r in V.movers(edge_run).collect()}
    assert known == {"top": "C", "bottom": "B"}
    positive = edge_run.filter("ticker in ('A', 'C')")
    assert {r.side: r.ticker for r in V.movers(positive).collect()} == {"top": "C", "bottom": "C"}
    zero = {r.side: r.ticker for r in V.movers(positive, null_as_zero=True).collect()}
    assert zero == {"top": "C", "bottom": "A"}


def test_histogram_overflow_is_not_counted(spark):
    values = [0.9, 1.9, 2.9, 3.9, 4.9, 5.9]
    run = spark.createDataFrame(
        [("r", day(0), "m", f"T{k}", 1.0, 1.0, None, v, at(0)) for k, v in enumerate(values)],
        PREDICTION)
    rows = V.histogram(run).filter("metric = 'gate'").orderBy("bin").collect()
    # Range 5 in 5 bins gives step 1 from 0: the bins end at 5 and 5.9 lies beyond.
    assert [(r.low, r.high, r.n) for r in rows] == [(float(k), k + 1.0, 1) for k in range(5)]
    assert rows[0].label == "0.0-1.0"
    flat = V.histogram(run).filter("metric = 'return_pct'").orderBy("bin").collect()
    assert [r.n for r in flat] == [6, 0, 0, 0, 0]
    assert flat[0].label == "0.0-0.2"


def test_limits_are_checked(edge_run):
    for bad in (0, 101):
        with pytest.raises(ValueError):
            V.recent_runs(edge_run, bad)
    with pytest.raises(ValueError):
        V.ticker_history(edge_run, "A", 201)


def test_timeline_label_falls_back_to_run_id(spark, edge_run):
    rows = edge_run.withColumn("created_at", F.lit(None).cast("timestamp")) \
        .withColumn("prediction_run_id", F.lit("run_20240101"))
    closes = bars(spark, {"A": [1.0, 7.0]})
    row = V.history_timeline(rows.filter("ticker = 'A'"), closes).first()
    assert (row.label, row.actual, row.confidence) == ("20240101", 7.0, pytest.approx(30.0))


def test_numbers_and_symbol_lists(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",), ("",)], "t string")
    assert [r[0] for r in df.select(P.to_number(F.col("t"))).collect()] == [1.5] + [None] * 4
    text = spark.createDataFrame([(" aapl, ,msft,,Sbux ",)], "t string")
    assert text.select(P.symbol_list("t")).first()[0] == ["AAPL", "MSFT", "SBUX"]


def test_report_text(spark):
    df = spark.createDataFrame([(1.23456, at(0)), (None, None)], "x double, ts timestamp")
    got = df.select(P.number_text("x", 2), P.utc_text("ts")).collect()
    assert got[0][0] == "1.23" and got[0][1].endswith(" UTC") and tuple(got[1]) == ("—", "—")


def test_too_few_samples_are_refused(spark):
    calendar = C.trading_calendar(bars(spark, {"A": [1.0] * 40}))
    with pytest.raises(DataCheckError):
        S.plan_steps(calendar, BacktestConfig(lookback=5, test_days=5, initial_train=15,
                                              val_days=10))


def test_paper_split(spark):
    rng = np.random.default_rng(1)
    frame = panel(spark, rng.normal(size=(30, 1)), ["A"])
    samples = S.build_samples(frame, 5, ["close", "ret"])
    split = {r.t: r.split for r in S.latest_split(samples, 4).collect()}
    assert split[29] == "test" and [split[t] for t in range(24, 30)] == \
        ["train"] + ["val"] * 4 + ["test"]


def test_graph_thresholds_on_correlated_panel(spark):
    from tests.panels import correlated
    returns = correlated(120, 9, seed=3)
    names = [f"S{k}" for k in range(9)]
    frame = panel(spark, returns, names)
    graph = G.build_graph(frame, frame.select("symbol").distinct(), G.snapshot_plan(120, 504),
                          GraphConfig())
    linked = {(r.src, r.dst) for r in graph.collect() if r.src != r.dst}
    assert linked == {(a, b) for i, a in enumerate(names) for j, b in enumerate(names)
                      if i != j and i % 3 == j % 3}
