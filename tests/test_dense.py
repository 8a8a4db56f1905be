"""Graphs and baselines against independent dense-matrix statements in NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.config import BacktestConfig, GraphConfig
from barloom.operators import baselines as L
from barloom.operators import graph as G
from barloom.operators import samples as S
from barloom.operators.pairs import pair_statistics
from tests.panels import correlated, panel

N_DATES, N_SYMBOLS = 90, 7
NAMES = [f"S{k}" for k in range(N_SYMBOLS)]
CONFIG = BacktestConfig(lookback=4, test_days=6, initial_train=60, val_days=10)
GRAPH = GraphConfig(recent_days=40, pearson_threshold=0.1, pearson_topk=3, min_support=0.1,
                    min_confidence=0.3, lift_threshold=1.05, assoc_topk=2, final_topk=2)


@pytest.fixture(scope="module")
def returns():
    return correlated(N_DATES, N_SYMBOLS, seed=5, noise=1.2)


@pytest.fixture(scope="module")
def closes(returns):
    return np.cumsum(returns, axis=0) * 10 + np.arange(N_SYMBOLS)


@pytest.fixture(scope="module")
def frame(spark, returns, closes):
    df = panel(spark, returns, NAMES, closes).cache()
    df.count()
    return df


@pytest.fixture(scope="module")
def plan():
    return S.StepPlan(N_DATES - CONFIG.test_days, CONFIG.test_days,
                      N_DATES - CONFIG.test_days - CONFIG.initial_train)


def dense_topk(m, k):
    out = np.zeros_like(m)
    for i in range(len(m)):
        order = sorted((j for j in range(len(m)) if j != i and m[i, j] > 0),
                       key=lambda j: (-round(m[i, j], 12), -j))
        for j in order[:k]:
            out[i, j] = m[i, j]
    return np.maximum(out, out.T)


def dense_graph(window):
    corr = np.abs(np.corrcoef(window.T))
    np.fill_diagonal(corr, 0)
    pearson = dense_topk(np.where(corr >= GRAPH.pearson_threshold, corr, 0), GRAPH.pearson_topk)
    n = window.shape[1]
    lift_matrix = np.zeros((n, n))
    for i in range(n):
        for j in range(n):
            if i == j:
                continue
            measures = []
            for moves in (window > 0, window < 0):
                both = (moves[:, i] & moves[:, j]).mean()
                pi, pj = moves[:, i].mean(), moves[:, j].mean()
                measures.append((both, both / (pi + 1e-8), both / (pi * pj + 1e-8)))
            support, confidence, lift = map(max, zip(*measures))
            if support >= GRAPH.min_support and confidence >= GRAPH.min_confidence \
                    and lift >= GRAPH.lift_threshold:
                lift_matrix[i, j] = lift
    if lift_matrix.max() > 0:
        lift_matrix = lift_matrix / lift_matrix.max()
    assoc = dense_topk(lift_matrix, GRAPH.assoc_topk)
    merged = dense_topk(np.maximum(pearson, GRAPH.assoc_weight * assoc), GRAPH.final_topk)
    np.fill_diagonal(merged, 1.0)
    scale = 1 / np.sqrt(np.maximum(merged.sum(axis=1), 1e-8))
    return merged, merged * np.outer(scale, scale)


def test_step_graphs(frame, returns, plan):
    edges = G.build_graph(frame, frame.select("symbol").distinct(), plan, GRAPH).collect()
    for step, start, end in plan.windows(GRAPH.recent_days):
        raw, normal = dense_graph(returns[start:end + 1])
        got_raw, got_normal = np.zeros_like(raw), np.zeros_like(raw)
        for e in edges:
            if e.step == step:
                i, j = NAMES.index(e.src), NAMES.index(e.dst)
                got_raw[i, j], got_normal[i, j] = e.weight, e.norm_weight
        assert np.allclose(got_raw, raw, atol=1e-9)
        assert np.allclose(got_normal, normal, atol=1e-9)
        assert np.allclose(got_raw, got_raw.T)
        assert np.allclose(np.diag(got_raw), 1.0)


@pytest.mark.parametrize("block", [1, 2, 3, 128])
def test_block_size_does_not_change_pairs(frame, plan, block):
    def rows(size):
        df = pair_statistics(frame, plan, GRAPH.recent_days, block=size)
        return sorted((r.step, r.a, r.b, round(r["corr"], 9), round(r.both_up, 9),
                       round(r.up_a, 9), round(r.down_b, 9)) for r in df.collect())
    want = rows(64)
    assert len(want) == plan.n_steps * N_SYMBOLS * (N_SYMBOLS - 1) // 2
    assert rows(block) == want


@pytest.mark.parametrize("windows", [
    [(0, 9), (1, 10), (2, 11)], [(0, 29)], [(0, 3), (0, 4), (0, 5)], [(3, 4), (8, 9), (9, 20), (19, 29)],
    [(k, k + 1) for k in range(28)], [(k // 2, 10 + k) for k in range(20)]])
def test_window_products(windows):
    from barloom.operators.pairs import Side, window_products
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(4, 30)), rng.normal(size=(3, 30))
    x[1, 5:] = 7.0
    got = list(window_products(x, y, windows))
    assert len(got) == len(windows)
    for (a, b), m in zip(windows, got):
        assert np.allclose(m, x[:, a:b + 1] @ y[:, a:b + 1].T, atol=1e-12)
    side = Side(x, windows)
    for k, (a, b) in enumerate(windows):
        part = x[:, a:b + 1]
        want = np.sqrt(((part - part.mean(axis=1, keepdims=True)) ** 2).sum(axis=1))
        assert np.allclose(side.spread(k, b - a + 1), want, atol=1e-9)
        assert side.still[k].tolist() == (part.max(axis=1) == part.min(axis=1)).tolist()


def test_leading_pairs_are_few_and_enough(spark):
    config = GraphConfig(recent_days=40, pearson_threshold=0.0, pearson_topk=2, min_support=0.0,
                         min_confidence=0.0, lift_threshold=0.0, assoc_topk=1, final_topk=2)
    returns = correlated(60, 40, seed=3, noise=2.0)
    returns[:, 5] = returns[:, 6]  # equal weights rank by name
    frame = panel(spark, returns, [f"S{k:02d}" for k in range(40)])
    plan = S.StepPlan(57, 3, 0)
    every = pair_statistics(frame, plan, 40, config, block=16)
    few = pair_statistics(frame, plan, 40, config, block=16, leading=True)
    n_blocks = 3
    assert every.count() == 3 * 40 * 39 // 2
    assert few.count() <= 3 * 40 * 2 * (2 + 1) * n_blocks / 2
    for part in ("pearson", "assoc", "combined"):
        def rows(pairs):
            return sorted((r.step, r.src, r.dst, round(r.weight, 9))
                          for r in G.graph_parts(pairs, config)[part].collect())
        assert rows(few) == rows(every)


def test_window_totals(spark, frame, returns, plan):
    steps = plan.frame(spark).withColumn("low", F.col("train_start") + 2)
    got = {(r.step, r.symbol): (r.n, r.ret) for r in S.window_totals(
        frame, ["symbol"], steps, "low", "train_end", {"n": F.lit(1), "ret": F.col("ret")}).collect()}
    for step, start, end in plan.windows():
        for j, name in enumerate(NAMES):
            n, total = got[(step, name)]
            part = returns[start + 2:end + 1, j]
            assert n == len(part) and total == pytest.approx(part.sum(), abs=1e-12)


def test_window_moments_merge_days(spark, plan):
    from barloom.operators.moments import daily_moments, window_moments
    rng = np.random.default_rng(0)
    values = 1e8 + rng.normal(size=(N_DATES, N_SYMBOLS))
    held = panel(spark, values, NAMES, values)
    got = {r.step: (r.ret_mean, r.ret_std) for r in window_moments(
        daily_moments(held, ["ret"]), plan.frame(spark), ["ret"]).collect()}
    for step, start, end in plan.windows():
        part = values[start:end + 1]
        assert got[step] == pytest.approx((part.mean(), part.std()), rel=1e-9)


def test_pair_filter_drops_nothing_that_a_graph_keeps(frame, plan):
    every = pair_statistics(frame, plan, GRAPH.recent_days)
    kept = pair_statistics(frame, plan, GRAPH.recent_days, GRAPH)
    for part in ("pearson", "assoc", "combined"):
        def rows(pairs):
            return sorted((r.step, r.src, r.dst, round(r.weight, 9))
                          for r in G.graph_parts(pairs, GRAPH)[part].collect())
        assert rows(kept) == rows(every)


def sequences(closes, ts, lookback):
    return np.stack([closes[t - lookback:t].T.reshape(-1) for t in ts])


@pytest.mark.parametrize("lookback, tile", [(4, (2, 4)), (4, (1_024, 64)), (12, (1_024, 64))])
def test_joint_regression(frame, closes, plan, lookback, tile, monkeypatch):
    monkeypatch.setattr(L, "SYMBOLS_PER_TILE", tile[0])
    monkeypatch.setattr(L, "STEPS_PER_TILE", tile[1])
    # lookback 12 has more coefficients than samples: the minimum-norm solution is meant.
    config = BacktestConfig(lookback=lookback, test_days=6, initial_train=60, val_days=10)
    got = {(r.step, r.symbol): r.pred_residual
           for r in L.joint_regression(frame, plan, config).collect()}
    for step in range(1, plan.n_steps + 1):
        test = plan.first_test + step - 1
        ts = np.arange(plan.train_start + lookback, test - config.val_days)
        x, y = sequences(closes, ts, lookback), closes[ts] - closes[ts - 1]
        coef = np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(axis=0), rcond=None)[0]
        want = y.mean(axis=0) + (sequences(closes, [test], lookback)[0] - x.mean(axis=0)) @ coef
        for j, name in enumerate(NAMES):
            assert got[(step, name)] == pytest.approx(want[j], abs=1e-6)


def test_ridge(frame, closes, plan):
    got = {(r.step, r.symbol): (r.alpha, r.pred_residual)
           for r in L.ridge_regression(frame, plan, CONFIG).collect()}
    for step in range(1, plan.n_steps + 1):
        test = plan.first_test + step - 1
        train = np.arange(plan.train_start + CONFIG.lookback, test - CONFIG.val_days)
        val = np.arange(test - CONFIG.val_days, test)
        for j, name in enumerate(NAMES):
            c = closes[:, j:j + 1]
            x, y = sequences(c, train, CONFIG.lookback), (c[train] - c[train - 1])[:, 0]
            xv, yv = sequences(c, val, CONFIG.lookback), (c[val] - c[val - 1])[:, 0]
            probe = sequences(c, [test], CONFIG.lookback)[0]
            fits = []
            for alpha in CONFIG.ridge_alphas:
                # Unpenalised intercept through an augmented least-squares problem.
                design = np.block([[np.ones((len(x), 1)), x],
                                   [np.zeros((4, 1)), np.sqrt(alpha) * np.eye(4)]])
                beta = np.linalg.lstsq(design, np.concatenate([y, np.zeros(4)]), rcond=None)[0]
                fits.append((np.mean((yv - beta[0] - xv @ beta[1:]) ** 2), alpha,
                             beta[0] + probe @ beta[1:]))
            best = min(range(len(fits)), key=lambda k: (fits[k][0], k))
            assert got[(step, name)][0] == fits[best][1]
            assert got[(step, name)][1] == pytest.approx(fits[best][2], abs=1e-9)


def test_pooled_regression(frame, closes, plan):
    got = {(r.step, r.symbol): r.pred_close
           for r in L.pooled_regression(frame, plan, CONFIG).collect()}
    for step in range(1, plan.n_steps + 1):
        test = plan.first_test + step - 1
        ts = np.arange(plan.train_start + CONFIG.lookback, test - CONFIG.val_days)
        x = np.concatenate([closes[t - 3:t].T for t in ts])
        y = np.concatenate([closes[t] for t in ts])
        design = np.column_stack([np.ones(len(x)), x])
        beta = np.linalg.lstsq(design, y, rcond=None)[0]
        want = beta[0] + closes[test - 3:test].T @ beta[1:]
        for j, name in enumerate(NAMES):
            assert got[(step, name)] == pytest.approx(want[j], abs=1e-8)


def test_neighbour_sums(frame, returns, plan):
    edges = G.build_graph(frame, frame.select("symbol").distinct(), plan, GRAPH)
    nodes = frame.filter(f"t = {plan.train_start}").select(
        F.explode(F.sequence(F.lit(1), F.lit(plan.n_steps))).alias("step"), "symbol", "ret")
    got = {(r.step, r.symbol): r.ret for r in G.neighbour_sums(edges, nodes, ["ret"]).collect()}
    for step, start, end in plan.windows(GRAPH.recent_days):
        want = dense_graph(returns[start:end + 1])[1] @ returns[plan.train_start]
        for j, name in enumerate(NAMES):
            assert got[(step, name)] == pytest.approx(want[j], abs=1e-9)


def test_pair_filter_keeps_what_rounds_up_to_the_threshold():
    import numpy as np
    from barloom.config import GraphConfig
    from barloom.operators.pairs import pair_filter
    config = GraphConfig(pearson_threshold=0.813112998137, min_support=2.0)
    none = np.zeros((1, 3))
    stats = {"corr": np.array([[0.8131129981367, -0.8131129981367, 0.8131129]]), "both_up": none,
             "both_down": none} | {k: none for k in ("up_a", "up_b", "down_a", "down_b")}
    assert pair_filter(config)(stats).tolist() == [[True, True, False]]
