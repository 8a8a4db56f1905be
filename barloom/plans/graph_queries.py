"""Queries over symbol graphs, snapshots and fitted baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import baselines as L
from barloom.operators import calendar as C
from barloom.operators import graph as G
from barloom.operators import samples as S
from barloom.operators import scoring
from barloom.operators.pairs import pair_statistics
from barloom.plans import inputs
from barloom.plans.inputs import BACKTEST, GRAPH
from barloom.plans.oracle_prefix import (BACKTEST_PREFIX, BAR_PREFIX, FEATURES, GRAPH_PREFIX,
                                         PANEL, TICK_PREFIX, graph_ctes)
from barloom.plans.registry import query
from barloom.plans.snapshots import snapshot_from_history, snapshot_from_ticks
from barloom.session import stage

EDGE_SPEC = "step:i src dst weight:f"
SNAP_STEP = """
snap AS (SELECT 1 AS step, max(t) AS train_end, greatest(0, max(t) + 1 - 120) AS graph_start
    FROM {cal})"""
SNAP_PREFIX = ",".join([BAR_PREFIX, SNAP_STEP.format(cal="panel_cal"),
                        graph_ctes("panel", "snap")])
MONTH_PREFIX = ",".join([
    BAR_PREFIX, FEATURES.format(name="mfeat", bars="bars_month"),
    PANEL.format(name="mpanel", feat="mfeat"), SNAP_STEP.format(cal="mpanel_cal"),
    graph_ctes("mpanel", "snap")])


def _setup(spark, sf_dir, leading=False):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_steps(calendar, BACKTEST)
    return panel, plan, pair_statistics(panel, plan, GRAPH.recent_days, GRAPH, leading=leading)


def _symbols(panel):
    return panel.select("symbol").distinct()


@query("gr1_pair_correlation", "step:i src dst corr:f both_up:f both_down:f", GRAPH_PREFIX,
       "SELECT * FROM directed")
def pair_correlation(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_steps(calendar, BACKTEST)
    return G.both_directions(pair_statistics(panel, plan, GRAPH.recent_days))


@query("jn3_month_pairs", "src dst corr:f both_up:f both_down:f", MONTH_PREFIX,
       "SELECT * FROM directed")
def month_pairs(spark, sf_dir):
    panel, calendar = inputs.month_panel(spark, sf_dir)
    plan = G.snapshot_plan(C.count_dates(calendar), GRAPH.recent_days)
    return G.both_directions(pair_statistics(panel, plan, GRAPH.recent_days))


@query("gr2_pearson_threshold", EDGE_SPEC, GRAPH_PREFIX, "SELECT * FROM pearson_raw")
def pearson_threshold(spark, sf_dir):
    _, _, pairs = _setup(spark, sf_dir)
    return G.pearson_edges(G.both_directions(pairs), GRAPH.pearson_threshold)


@query("gr3_pearson_topk", EDGE_SPEC, GRAPH_PREFIX, "SELECT * FROM pearson")
def pearson_topk(spark, sf_dir):
    _, _, pairs = _setup(spark, sf_dir, leading=True)
    edges = G.pearson_edges(G.both_directions(pairs), GRAPH.pearson_threshold)
    return G.keep_topk(edges, GRAPH.pearson_topk)


@query("gr4_movement_frequencies", "step:i symbol p_up:f p_down:f", GRAPH_PREFIX,
       "SELECT * FROM freq")
def movement_frequencies(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    steps = S.plan_steps(calendar, BACKTEST).frame(spark)
    return G.movement_frequencies(panel, steps, GRAPH.recent_days)


@query("gr4_mean_frequencies", "step:i avg_p_up:f avg_p_down:f", GRAPH_PREFIX, """
SELECT step, avg(p_up) AS avg_p_up, avg(p_down) AS avg_p_down FROM freq GROUP BY 1""")
def mean_frequencies(spark, sf_dir):
    return G.mean_frequencies(movement_frequencies(spark, sf_dir))


@query("gr5_association_rules", "step:i src dst support:f confidence:f lift:f", GRAPH_PREFIX,
       "SELECT * FROM rules")
def association_rules(spark, sf_dir):
    return G.association_rules(pair_correlation(spark, sf_dir))


@query("gr5_association_edges", EDGE_SPEC, GRAPH_PREFIX, "SELECT * FROM assoc_raw")
def association_edges(spark, sf_dir):
    _, _, pairs = _setup(spark, sf_dir)
    return G.association_edges(G.association_rules(G.both_directions(stage(pairs))), GRAPH)


@query("gr6_combined_graph", EDGE_SPEC, GRAPH_PREFIX, "SELECT * FROM combined")
def combined_graph(spark, sf_dir):
    _, _, pairs = _setup(spark, sf_dir, leading=True)
    return G.graph_parts(pairs, GRAPH)["combined"]


@query("gr7_normalised_loops", "src norm_weight:f n_edges:i", SNAP_PREFIX, """
SELECT src, sum(norm_weight) AS norm_weight, count(*) AS n_edges FROM graph GROUP BY 1""")
def normalised_loops(spark, sf_dir):
    return snapshot_graph(spark, sf_dir).groupBy("src").agg(
        F.sum("norm_weight").alias("norm_weight"), F.count("*").alias("n_edges"))


@query("gr8_step_graphs", EDGE_SPEC + " norm_weight:f", GRAPH_PREFIX, "SELECT * FROM graph")
def step_graphs(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    return G.build_graph(panel, _symbols(panel), S.plan_steps(calendar, BACKTEST), GRAPH)


@query("gr9_snapshot_graph", EDGE_SPEC + " norm_weight:f", SNAP_PREFIX, "SELECT * FROM graph")
def snapshot_graph(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = G.snapshot_plan(C.count_dates(calendar), GRAPH.recent_days)
    return G.build_graph(panel, _symbols(panel), plan, GRAPH)


@query("gr9_month_graph", "src dst weight:f norm_weight:f", MONTH_PREFIX, "SELECT * FROM graph")
def month_graph(spark, sf_dir):
    panel, calendar = inputs.month_panel(spark, sf_dir)
    plan = G.snapshot_plan(C.count_dates(calendar), GRAPH.recent_days)
    return G.build_graph(panel, _symbols(panel), plan, GRAPH)


COUNT_SQL = """
SELECT s.step, (SELECT count(*) FROM pearson e WHERE e.step = s.step) AS pearson_edges,
    (SELECT count(*) FROM assoc e WHERE e.step = s.step) AS assoc_edges,
    (SELECT count(*) FROM combined e WHERE e.step = s.step) AS combined_edges FROM steps s"""


@query("agg15_edge_counts", "step:i pearson_edges:i assoc_edges:i combined_edges:i",
       GRAPH_PREFIX, COUNT_SQL)
def edge_counts(spark, sf_dir):
    _, plan, pairs = _setup(spark, sf_dir, leading=True)
    return G.edge_counts(G.graph_parts(pairs, GRAPH), plan.frame(spark))


@query("agg15_mean_edge_counts",
       "mean_pearson_edges:f mean_assoc_edges:f mean_combined_edges:f", GRAPH_PREFIX, f"""
SELECT avg(pearson_edges) AS mean_pearson_edges, avg(assoc_edges) AS mean_assoc_edges,
    avg(combined_edges) AS mean_combined_edges FROM ({COUNT_SQL}) c""")
def mean_edge_counts(spark, sf_dir):
    return G.mean_edge_counts(edge_counts(spark, sf_dir))


HOP_SQL = """
hop1 AS (SELECT g.step, g.src AS symbol, sum(g.norm_weight * p.ret) AS ret,
    sum(g.norm_weight * p.vol5) AS vol5 FROM graph g JOIN steps s ON g.step = s.step
    JOIN panel p ON p.t = s.train_end AND p.symbol = g.dst GROUP BY 1, 2),
hop2 AS (SELECT g.step, g.src AS symbol, sum(g.norm_weight * h.ret) AS ret,
    sum(g.norm_weight * h.vol5) AS vol5 FROM graph g
    JOIN hop1 h ON h.step = g.step AND h.symbol = g.dst GROUP BY 1, 2)"""


@query("jn7_neighbour_sums", "hops:i step:i symbol ret:f vol5:f", GRAPH_PREFIX + "," + HOP_SQL,
       "SELECT 1 AS hops, * FROM hop1 UNION ALL SELECT 2, * FROM hop2")
def neighbour_sums(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_steps(calendar, BACKTEST)
    edges = stage(G.build_graph(panel, _symbols(panel), plan, GRAPH), "edges")
    steps = plan.frame(spark).select("step", F.col("train_end").alias("t"))
    nodes = panel.select("t", "symbol", "ret", "vol5").join(F.broadcast(steps), "t")
    columns = ["ret", "vol5"]
    one = G.neighbour_sums(edges, nodes, columns)
    two = G.neighbour_sums(edges, one, columns)
    return one.withColumn("hops", F.lit(1)).unionByName(two.withColumn("hops", F.lit(2)))


@query("bt3_history_snapshot", "as_of_date:d symbol last_close:f first_seq:f last_seq:f seq_sum:f "
       "node_ret:f node_vol20:f", BAR_PREFIX, """
SELECT max(date) OVER () AS as_of_date, symbol, last_close, first_seq, last_seq, seq_sum, node_ret,
    node_vol20 FROM (SELECT t, date, symbol, close AS last_close,
    lag(close, 19) OVER w AS first_seq, close AS last_seq,
    sum(close) OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
        AS seq_sum, ret AS node_ret, vol20 AS node_vol20
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY t)) x
WHERE t = (SELECT max(t) FROM panel_cal)""")
def history_snapshot(spark, sf_dir):
    snapshot = snapshot_from_history(inputs.bars_day(spark, sf_dir), BACKTEST.lookback)
    return _flat_snapshot(snapshot.rows())


def _tick_snapshot(spark, sf_dir):
    return snapshot_from_ticks(inputs.bars_event_day(spark, sf_dir),
                               inputs.ticks(spark, sf_dir), 5)


def _flat_snapshot(rows):
    return rows.select(
        "as_of_date", "symbol", "last_close", F.get("seq", F.lit(0)).alias("first_seq"),
        F.element_at("seq", -1).alias("last_seq"),
        F.aggregate("seq", F.lit(0.0), lambda a, x: a + x).alias("seq_sum"),
        F.get("node", F.lit(2)).alias("node_ret"), F.get("node", F.lit(6)).alias("node_vol20"))


TICK_SNAPSHOT_PREFIX = ",".join([TICK_PREFIX, """
live AS (SELECT b.symbol, b.date, coalesce(l.price, b.open) AS open,
    coalesce(l.price, b.high) AS high, coalesce(l.price, b.low) AS low,
    coalesce(l.price, b.close) AS close, b.volume FROM bars_event b LEFT JOIN latest l
    ON b.symbol = l.symbol AND b.date = CAST(l.event_time AS DATE))""",
    FEATURES.format(name="lfeat", bars="live"), PANEL.format(name="lpanel", feat="lfeat"),
    SNAP_STEP.format(cal="lpanel_cal"), graph_ctes("lpanel", "snap")])


@query("bt4_tick_snapshot", "as_of_date:d symbol last_close:f first_seq:f last_seq:f seq_sum:f "
       "node_ret:f node_vol20:f", TICK_SNAPSHOT_PREFIX, """
SELECT (SELECT max(CAST(event_time AS DATE)) FROM latest) AS as_of_date, symbol, last_close,
    first_seq, last_seq, seq_sum, node_ret, node_vol20 FROM (
    SELECT t, symbol, close AS last_close, lag(close, 4) OVER w AS first_seq, close AS last_seq,
    sum(close) OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
        AS seq_sum, ret AS node_ret, vol20 AS node_vol20
    FROM lpanel WINDOW w AS (PARTITION BY symbol ORDER BY t)) x
WHERE t = (SELECT max(t) FROM lpanel_cal)""")
def tick_snapshot(spark, sf_dir):
    return _flat_snapshot(_tick_snapshot(spark, sf_dir).rows())


@query("bt4_tick_snapshot_graph", "src dst weight:f norm_weight:f", TICK_SNAPSHOT_PREFIX,
       "SELECT * FROM graph")
def tick_snapshot_graph(spark, sf_dir):
    return _tick_snapshot(spark, sf_dir).graph(GRAPH)


def _scaled_setup(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_steps(calendar, BACKTEST)
    return stage(inputs.scaled_panel(panel, plan, ["close"])), plan


FORECAST_SPEC = "model step:i date:d ticker y_true:f y_pred:f last_close:f"


def _solved(name: str, systems: str, keys: str, n: int, width: int) -> str:
    """CTE ``name``: systems (keys, m) of n equations after Gauss-Jordan elimination, as lists of rows."""
    return f"""
{name}_steps AS (SELECT {keys}, 0 AS k, m FROM {systems} UNION ALL
    SELECT {keys}, k + 1, list_transform(range(1, {n} + 1), lambda i: CASE WHEN i = k + 1
        THEN list_transform(m[k + 1], lambda v: v / m[k + 1][k + 1])
        ELSE list_transform(range(1, {width} + 1),
            lambda j: m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END)
    FROM {name}_steps WHERE k < {n}),
{name} AS (SELECT {keys}, m FROM {name}_steps WHERE k = {n})"""


SEQUENCES_SQL = """
seqs AS (SELECT t, date, symbol, close, lag(close) OVER w AS last_close,
    list(close) OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS x
    FROM scaled WINDOW w AS (PARTITION BY symbol ORDER BY t)),
full_seqs AS (SELECT *, close - last_close AS y FROM seqs WHERE t >= 20)"""

# All symbols' sequences of a date in a row; the normal equations of each step for every symbol at once.
JOINT_SQL = f"""
WITH RECURSIVE {SEQUENCES_SQL},
wide AS (SELECT t, flatten(list(x ORDER BY symbol)) AS x, list(y ORDER BY symbol) AS y FROM full_seqs
    GROUP BY t),
cells AS (SELECT t, unnest(range(1, 101)) AS i, unnest(x) AS v FROM wide),
out_cells AS (SELECT t, unnest(range(1, 6)) AS o, unnest(y) AS v FROM wide),
train AS (SELECT s.step, c.* FROM cells c JOIN steps s ON c.t BETWEEN s.train_start + 20 AND s.test_t - 21),
means AS (SELECT step, list(m ORDER BY i) AS mx FROM (SELECT step, i, avg(v) AS m FROM train GROUP BY 1, 2) a
    GROUP BY 1),
gram AS (SELECT a.step, a.i, b.i AS j, covar_pop(a.v, b.v) AS c FROM train a
    JOIN train b ON a.step = b.step AND a.t = b.t GROUP BY 1, 2, 3
    UNION ALL SELECT a.step, a.i, 100 + b.o, covar_pop(a.v, b.v) FROM train a JOIN out_cells b ON a.t = b.t
    GROUP BY 1, 2, 3),
gram_rows AS (SELECT step, i, list(c ORDER BY j) AS r FROM gram GROUP BY 1, 2),
systems AS (SELECT step, list(r ORDER BY i) AS m FROM gram_rows GROUP BY 1),
{_solved("done", "systems", "step", 100, 105)},
levels AS (SELECT s.step, o, avg(v) AS my FROM out_cells c
    JOIN steps s ON c.t BETWEEN s.train_start + 20 AND s.test_t - 21 GROUP BY 1, 2),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY symbol) AS o FROM full_seqs)
SELECT 'ols' AS model, s.step, r.date, r.symbol AS ticker, r.close AS y_true,
    r.last_close + l.my + list_dot_product(list_transform(d.m, lambda row: row[100 + r.o]),
        list_transform(range(1, 101), lambda i: w.x[i] - n.mx[i])) AS y_pred, r.last_close
FROM steps s JOIN ranked r ON r.t = s.test_t JOIN wide w ON w.t = s.test_t JOIN done d ON d.step = s.step
JOIN means n ON n.step = s.step JOIN levels l ON l.step = s.step AND l.o = r.o"""

RIDGE_SQL = f"""
WITH RECURSIVE {SEQUENCES_SQL},
train AS (SELECT s.step, f.symbol, f.t, f.x, f.y FROM full_seqs f
    JOIN steps s ON f.t BETWEEN s.train_start + 20 AND s.test_t - 21),
cells AS (SELECT step, symbol, t, y, unnest(range(1, 21)) AS i, unnest(x) AS v FROM train),
gram AS (SELECT a.step, a.symbol, a.i, b.i AS j, covar_pop(a.v, b.v) * count(*) AS c FROM cells a
    JOIN cells b ON a.step = b.step AND a.symbol = b.symbol AND a.t = b.t GROUP BY 1, 2, 3, 4
    UNION ALL SELECT step, symbol, i, 21, covar_pop(v, y) * count(*) FROM cells GROUP BY 1, 2, 3),
means AS (SELECT step, symbol, list(m ORDER BY i) AS mx, min(my) AS my FROM (
    SELECT step, symbol, i, avg(v) AS m, avg(y) AS my FROM cells GROUP BY 1, 2, 3) a GROUP BY 1, 2),
penalties AS (SELECT unnest([0.01, 0.1, 1.0, 10.0, 100.0]) AS alpha),
gram_rows AS (SELECT step, symbol, alpha, i,
    list(c + CASE WHEN i = j THEN alpha ELSE 0 END ORDER BY j) AS r FROM gram, penalties GROUP BY 1, 2, 3, 4),
systems AS (SELECT step, symbol, alpha, list(r ORDER BY i) AS m FROM gram_rows GROUP BY 1, 2, 3),
{_solved("done", "systems", "step, symbol, alpha", 20, 21)},
fits AS (SELECT d.step, d.symbol, d.alpha, list_transform(d.m, lambda row: row[21]) AS b, n.mx, n.my
    FROM done d JOIN means n ON n.step = d.step AND n.symbol = d.symbol),
guesses AS (SELECT s.step, f.symbol, g.alpha, f.t, f.date, f.y, f.close, f.last_close, s.test_t,
    g.my + list_dot_product(g.b, list_transform(range(1, 21), lambda i: f.x[i] - g.mx[i])) AS p
    FROM full_seqs f JOIN steps s ON f.t BETWEEN s.test_t - 20 AND s.test_t
    JOIN fits g ON g.step = s.step AND g.symbol = f.symbol),
chosen AS (SELECT step, symbol, alpha, row_number() OVER (PARTITION BY step, symbol ORDER BY mse, alpha) AS k
    FROM (SELECT step, symbol, alpha, avg(pow(y - p, 2)) AS mse FROM guesses WHERE t < test_t
        GROUP BY 1, 2, 3) e)
SELECT 'ridge' AS model, g.step, g.date, g.symbol AS ticker, g.close AS y_true, g.last_close + g.p AS y_pred,
    g.last_close
FROM guesses g JOIN chosen c ON c.step = g.step AND c.symbol = g.symbol AND c.alpha = g.alpha AND c.k = 1
WHERE g.t = g.test_t"""


@query("bt5_joint_regression", FORECAST_SPEC, BACKTEST_PREFIX, JOINT_SQL)
def joint_regression(spark, sf_dir):
    panel, plan = _scaled_setup(spark, sf_dir)
    predicted = L.joint_regression(panel, plan, BACKTEST)
    return L.collect_predictions(L.residuals(panel), predicted, plan, "ols")


@query("bt6_ridge_regression", FORECAST_SPEC, BACKTEST_PREFIX, RIDGE_SQL)
def ridge_regression(spark, sf_dir):
    panel, plan = _scaled_setup(spark, sf_dir)
    predicted = L.ridge_regression(panel, plan, BACKTEST)
    return L.collect_predictions(L.residuals(panel), predicted, plan, "ridge")


POOLED_SQL = """
lagged AS (SELECT t, symbol, lag(close, 3) OVER w AS x1, lag(close, 2) OVER w AS x2,
    lag(close) OVER w AS x3, close AS y FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY t)),
cov AS (SELECT s.step, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my,
    covar_pop(x1, x1) AS a, covar_pop(x1, x2) AS b, covar_pop(x1, x3) AS c,
    covar_pop(x2, x2) AS d, covar_pop(x2, x3) AS e, covar_pop(x3, x3) AS f,
    covar_pop(x1, y) AS p, covar_pop(x2, y) AS q, covar_pop(x3, y) AS r
    FROM lagged l JOIN steps s ON l.t BETWEEN s.train_start + 20 AND s.test_t - 21 GROUP BY 1),
det AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS dd FROM cov),
coef AS (SELECT step, m1, m2, m3, my,
    (p * (d * f - e * e) - b * (q * f - e * r) + c * (q * e - d * r)) / dd AS b1,
    (a * (q * f - e * r) - p * (b * f - c * e) + c * (b * r - q * c)) / dd AS b2,
    (a * (d * r - q * e) - b * (b * r - q * c) + p * (b * e - d * c)) / dd AS b3 FROM det)"""


@query("bt7_pooled_regression", "step:i symbol target:f last_close:f pred_close:f",
       BACKTEST_PREFIX + "," + POOLED_SQL, """
SELECT c.step, l.symbol, l.y AS target, l.x3 AS last_close,
    my + b1 * (x1 - m1) + b2 * (x2 - m2) + b3 * (x3 - m3) AS pred_close
FROM coef c JOIN steps s ON c.step = s.step JOIN lagged l ON l.t = s.test_t""")
def pooled_regression(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    return L.pooled_regression(panel, S.plan_steps(calendar, BACKTEST), BACKTEST)


@query("bt8_collected_predictions", FORECAST_SPEC, BACKTEST_PREFIX, """
SELECT 'drift' AS model, s.step, k.date, k.symbol AS ticker, k.target AS y_true,
    k.last_close + d.drift AS y_pred, k.last_close
FROM samples k JOIN steps s ON k.t = s.test_t JOIN (
    SELECT s.step, k.symbol, avg(k.residual) AS drift FROM samples k
    JOIN steps s ON k.t BETWEEN s.train_start + 20 AND s.train_end GROUP BY 1, 2) d
ON d.step = s.step AND d.symbol = k.symbol""")
def collected_predictions(spark, sf_dir):
    """Mean training residual as the predicted residual."""
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_steps(calendar, BACKTEST)
    rows = L.residuals(panel)
    windows = plan.frame(spark).withColumn("low", F.col("train_start") + BACKTEST.lookback)
    totals = S.window_totals(rows, ["symbol"], windows, "low", "train_end",
                             {"n": F.lit(1), "residual": F.col("residual")})
    drift = totals.select("step", "symbol", (F.col("residual") / F.col("n")).alias("pred_residual"))
    return L.collect_predictions(rows, drift, plan, "drift")


BLEND_SQL = """
alphas AS (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0]) AS alpha),
cand AS (SELECT s.step, a.alpha,
    avg(pow(m.y_true - (1 - a.alpha) * m.naive - a.alpha * m.ma5, 2)) AS mse
    FROM msamples m JOIN steps s ON m.t BETWEEN s.test_t - 20 AND s.test_t - 1, alphas a
    GROUP BY 1, 2),
best AS (SELECT step, alpha, mse FROM (SELECT *, row_number() OVER (PARTITION BY step
    ORDER BY mse, alpha) AS rk FROM cand) r WHERE rk = 1)"""


def _blend_inputs(spark, sf_dir):
    panel, calendar = inputs.day_panel(spark, sf_dir)
    plan = S.plan_steps(calendar, BACKTEST)
    rows = stage(inputs.model_samples(panel, plan).select(
        "t", "date", "ticker", "y_true", F.col("naive").alias("p1"), F.col("ma5").alias("p2")))
    steps = plan.frame(spark)
    windows = steps.withColumn("low", F.col("test_t") - BACKTEST.val_days)
    validation = L.blend_errors(rows, windows, "low", "train_end", BACKTEST.blend_alphas)
    test = rows.join(F.broadcast(steps.select("step", F.col("test_t").alias("t"))), "t")
    return validation, test


@query("bt9_blend_candidates", "step:i alpha:f mse:f", BACKTEST_PREFIX + "," + BLEND_SQL,
       "SELECT * FROM cand")
def blend_candidates(spark, sf_dir):
    return _blend_inputs(spark, sf_dir)[0]


@query("bt9_blended_test", "step:i date:d ticker alpha:f y_true:f y_pred:f",
       BACKTEST_PREFIX + "," + BLEND_SQL, """
SELECT t.step, t.date, t.ticker, b.alpha, t.y_true,
    (1 - b.alpha) * t.naive + b.alpha * t.ma5 AS y_pred
FROM tests t JOIN best b ON t.step = b.step""")
def blended_test(spark, sf_dir):
    validation, test = _blend_inputs(spark, sf_dir)
    return L.apply_blend(test, L.best_blend(validation))


@query("bt11_scored_snapshots", "snapshot as_of_date:d ticker last_close:f pred_close:f "
       "pred_return:f", BAR_PREFIX, """
SELECT 't' || t AS snapshot, date AS as_of_date, symbol AS ticker, last_close,
    0.5 * last_close + 0.5 * mean5 AS pred_close,
    CASE WHEN abs(last_close) > 1e-12 THEN (0.5 * mean5 - 0.5 * last_close) / abs(last_close) END
        AS pred_return
FROM (SELECT t, date, symbol, close AS last_close, avg(close) OVER (PARTITION BY symbol ORDER BY t
    ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS mean5 FROM panel) x WHERE t >= 19""")
def scored_snapshots(spark, sf_dir):
    """Half way back to the five-day mean, as a linear scorer on the sequence."""
    import numpy as np
    pull = np.zeros(BACKTEST.lookback)
    pull[-5:] = 0.1
    pull[-1] -= 0.5
    rows = S.serving_sequences(inputs.day_panel(spark, sf_dir)[0], BACKTEST.lookback)
    snapshots = rows.select(F.concat(F.lit("t"), "t").alias("snapshot"),
                            F.col("date").alias("as_of_date"), "symbol", "seq", "node",
                            "last_close")
    return scoring.score_rows(snapshots, scoring.linear_scorer(pull, 0.0))


@query("bt12_stored_run", "prediction_run_id as_of_date:d model_name ticker last_close:f "
       "pred_close:f pred_return:f created_at:t", BAR_PREFIX, """
SELECT 'run_20300101_000000' AS prediction_run_id, date AS as_of_date, 'naive' AS model_name,
    symbol AS ticker, close AS last_close, close AS pred_close, 0.0 AS pred_return,
    TIMESTAMP '2030-01-01 00:00:00' AS created_at
FROM panel WHERE t = (SELECT max(t) FROM panel_cal)""")
def stored_run(spark, sf_dir):
    rows = snapshot_from_history(inputs.bars_day(spark, sf_dir), BACKTEST.lookback).rows()
    scored = scoring.score_rows(rows.withColumn("snapshot", F.lit("last")), scoring.naive_scorer)
    at = F.to_timestamp(F.lit("2030-01-01 00:00:00"))
    return scoring.stored_run(scored, "naive", scoring.run_id("run", at), at)
