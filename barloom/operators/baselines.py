"""Linear baselines fitted per expanding step.

None of them brings the whole panel of a step into one task: the joint regression works
on date-by-date products summed over symbols, the per-symbol ridge on one symbol's
vector, and the pooled regression on moments per date.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.config import BacktestConfig
from barloom.operators.pairs import count_symbols, pack_vectors, spread
from barloom.operators.samples import StepPlan, by_t, rows_in_windows, slice_range

STEPS_PER_SOLVE = 4
SYMBOLS_PER_FIT = 64
# A tile of the joint regression's last product: residual vectors of so many symbols x weights of steps.
SYMBOLS_PER_TILE = 1_024
STEPS_PER_TILE = 64
# Squared singular values below this share of the largest count as zero.
RANK_TOLERANCE = 1e-12


def residuals(panel: DataFrame) -> DataFrame:
    """Close minus the close before it, with that last close; first date drops out."""
    return panel.select("t", "date", "symbol", F.lag("close").over(by_t()).alias("last_close"),
                        F.col("close").alias("target")).dropna(subset=["last_close"]) \
        .withColumn("residual", F.col("target") - F.col("last_close"))


def date_products(panel: DataFrame, start: int, end: int) -> DataFrame:
    """``(u, products)``: sum over symbols of close[u] * close[v] for each v <= u in the range.

    Each task folds its symbols into one matrix, dates x dates, so the shuffle does not
    grow with the number of symbols. Closes enter as deviations from the symbol's mean,
    which changes no fit with an intercept and keeps the products accurate.
    """
    size = end - start + 1

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        seen = False
        for batch in batches:
            if len(batch):
                seen = True
                block = np.stack(batch["vec"].to_numpy())
                block = block - block.mean(axis=1, keepdims=True)
                total += block.T @ block
        if seen:
            yield pd.DataFrame({"u": np.arange(start, end + 1, dtype=np.int32),
                                "products": [total[k, :k + 1] for k in range(size)]})

    partial = pack_vectors(panel, start, end, "close") \
        .mapInPandas(fold, "u int, products array<double>")
    cells = partial.select("u", F.posexplode("products").alias("v", "product"))
    summed = cells.groupBy("u", "v").agg(F.sum("product").alias("product"))
    points = summed.groupBy("u").agg(
        F.array_sort(F.collect_list(F.struct("v", "product"))).alias("points"))
    return points.select("u", F.col("points.product").alias("products"))


def full_matrix(rows: list[np.ndarray]) -> np.ndarray:
    """Symmetric matrix from its lower triangle."""
    lower = np.zeros((len(rows), len(rows)))
    for k, row in enumerate(rows):
        lower[k, :k + 1] = row
    return lower + np.tril(lower, -1).T


def smoother_weights(products: np.ndarray, offset: int, train: np.ndarray, test: int,
                     lookback: int) -> np.ndarray:
    """Weight of each training sample in the least-squares prediction for ``test``.

    Minimum-norm least squares with intercept on flattened sequences, in dual form: the
    prediction is a weighted sum of training targets, and the weights depend on the
    sequences only through their inner products.
    """
    lags = np.arange(lookback)
    rows = train[:, None] - lookback + lags - offset
    probe = test - lookback + lags - offset
    kernel = sum(products[np.ix_(rows[:, k], rows[:, k])] for k in lags)
    cross = sum(products[rows[:, k], probe[k]] for k in lags)
    mean_row = kernel.mean(axis=1)
    centred = kernel - mean_row[:, None] - mean_row[None, :] + kernel.mean()
    target = cross - mean_row
    target = target - target.mean()
    values, vectors = np.linalg.eigh(centred)
    good = values > RANK_TOLERANCE * values.max()
    part = vectors[:, good]
    return 1.0 / len(train) + part @ ((part.T @ target) / values[good])


def joint_weights(panel: DataFrame, plan: StepPlan, config: BacktestConfig) -> DataFrame:
    """``(step, first, weights)`` of the multi-output regression on all symbols' sequences.

    ``weights`` are those of the training dates from ``first`` on.
    """
    low, high = plan.train_start, plan.first_test + plan.n_steps - 2
    first_sample = plan.train_start + config.lookback
    chunks = [list(range(s, min(s + STEPS_PER_SOLVE, plan.n_steps + 1)))
              for s in range(1, plan.n_steps + 1, STEPS_PER_SOLVE)]

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        products = full_matrix(list(rows.sort_values("u")["products"]))
        frames = []
        for step in chunks[int(rows["chunk"].iloc[0])]:
            test = plan.first_test + step - 1
            train = np.arange(first_sample, test - config.val_days)
            weight = smoother_weights(products, low, train, test, config.lookback)
            frames.append((step, first_sample, weight))
        return pd.DataFrame(frames, columns=["step", "first", "weights"]).astype(
            {"step": "int32", "first": "int32"})

    chunk = F.explode(F.sequence(F.lit(0), F.lit(len(chunks) - 1)))
    copies = date_products(panel, low, high).withColumn("chunk", chunk)
    return spread(copies, 2 * len(chunks), "chunk") \
        .groupBy("chunk").applyInPandas(solve, "step int, first int, weights array<double>")


def joint_regression(panel: DataFrame, plan: StepPlan, config: BacktestConfig) -> DataFrame:
    """Predicted residual per step and symbol by multi-output least squares.

    The prediction is a product of two matrices, residuals (symbols x dates) and weights (dates x
    steps). A task multiplies a block of symbols' vectors with a block of steps' weights; no row
    stands for a symbol, date and step.
    """
    low, high = plan.train_start, plan.first_test + plan.n_steps - 2
    n_blocks = max(1, math.ceil(count_symbols(panel, high) / SYMBOLS_PER_TILE))
    n_chunks = math.ceil(plan.n_steps / STEPS_PER_TILE)

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    symbols = pack_vectors(panel, low, high, "close").select(
        F.pmod(F.xxhash64("symbol"), F.lit(n_blocks)).cast("int").alias("block"),
        each(n_chunks).alias("chunk"), "symbol", F.lit(None).cast("int").alias("step"),
        F.lit(0).alias("first"), "vec")
    steps = joint_weights(panel, plan, config).select(
        each(n_blocks).alias("block"), F.expr(f"(step - 1) div {STEPS_PER_TILE}").cast("int").alias("chunk"),
        F.lit(None).cast("string").alias("symbol"), "step", "first", F.col("weights").alias("vec"))

    def multiply(tile: pd.DataFrame) -> pd.DataFrame:
        held, asked = tile[tile["step"].isna()], tile[tile["step"].notna()]
        if held.empty or asked.empty:
            return pd.DataFrame({"step": [], "symbol": [], "pred_residual": []}).astype(
                {"step": "int32", "symbol": object, "pred_residual": float})
        residual = np.diff(np.stack(held["vec"].to_numpy()), axis=1)  # of low + 1 and on
        weights = np.zeros((len(asked), residual.shape[1]))
        for row, first, values in zip(weights, asked["first"], asked["vec"]):
            row[first - low - 1:first - low - 1 + len(values)] = values
        return pd.DataFrame({"step": np.repeat(asked["step"].to_numpy(np.int32), len(held)),
                             "symbol": np.tile(held["symbol"].to_numpy(), len(asked)),
                             "pred_residual": (weights @ residual.T).ravel()})

    tiles = spread(symbols.unionByName(steps), n_blocks * n_chunks, "block", "chunk")
    return tiles.groupBy("block", "chunk").applyInPandas(
        multiply, "step int, symbol string, pred_residual double")


def ridge_paths(closes: np.ndarray, lookback: int, tests: list[int], val_days: int,
                alphas: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Best penalty by validation error (first wins) and predicted residual: symbols x tests.

    All symbols of ``closes`` (symbols x dates) are fitted together. Training ranges begin at
    ``lookback`` and end ``val_days`` before each test, so a test's moments are those of the one before
    plus its new days; one eigen-decomposition of a symbol's moments serves every penalty.
    """
    x = np.lib.stride_tricks.sliding_window_view(closes, lookback, axis=1)
    y = np.diff(closes, axis=1)[:, lookback - 1:]
    # Row k of a symbol is the sample of date lookback + k. The shift keeps the moments small.
    first = tests[0] - val_days - lookback
    shift = x[:, :first].mean(axis=1, keepdims=True)
    x = x - shift
    gram, total = np.zeros((len(closes), lookback, lookback)), np.zeros((len(closes), lookback))
    moment, level = np.zeros((len(closes), lookback)), np.zeros(len(closes))
    n, chosen, predicted = 0, [], []
    penalties = np.array(alphas)
    for test in tests:
        end = test - val_days - lookback
        new, new_y = x[:, n:end], y[:, n:end]
        gram += new.transpose(0, 2, 1) @ new
        moment += (new.transpose(0, 2, 1) @ new_y[:, :, None])[:, :, 0]
        total += new.sum(axis=1)
        level += new_y.sum(axis=1)
        n = end
        mean, mean_y = total / n, level / n
        values, vectors = np.linalg.eigh(gram - n * mean[:, :, None] * mean[:, None, :])
        turned = vectors.transpose(0, 2, 1) @ (moment - n * mean * mean_y[:, None])[:, :, None]
        # symbols x dates x penalties
        coef = vectors @ (turned / (values[:, :, None] + penalties))
        off = mean_y[:, None, None] - mean[:, None, :] @ coef
        errors = ((y[:, end:end + val_days, None] - off - x[:, end:end + val_days] @ coef) ** 2).mean(axis=1)
        best = errors.argmin(axis=1)
        chosen.append(penalties[best])
        guess = (off + x[:, test - lookback][:, None, :] @ coef)[:, 0]
        predicted.append(guess[np.arange(len(closes)), best])
    return np.stack(chosen, axis=1), np.stack(predicted, axis=1)


def ridge_regression(panel: DataFrame, plan: StepPlan, config: BacktestConfig) -> DataFrame:
    """Ridge per symbol and step; one input row holds one symbol's whole vector.

    All steps of a stack of symbols are fitted from their rows, so sequences are not copied
    per step.
    """
    low, high = plan.train_start, plan.first_test + plan.n_steps - 2
    tests = [plan.first_test + k - low for k in range(plan.n_steps)]
    schema = "step int, symbol string, alpha double, pred_residual double"

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), SYMBOLS_PER_FIT):
                part = batch.iloc[k:k + SYMBOLS_PER_FIT]
                alpha, predicted = ridge_paths(np.stack(part["vec"].to_numpy()), config.lookback, tests,
                                               config.val_days, config.ridge_alphas)
                yield pd.DataFrame({
                    "step": np.tile(np.arange(1, plan.n_steps + 1, dtype=np.int32), len(part)),
                    "symbol": np.repeat(part["symbol"].to_numpy(), plan.n_steps),
                    "alpha": alpha.ravel(), "pred_residual": predicted.ravel()})

    tasks = math.ceil(count_symbols(panel, high) / SYMBOLS_PER_FIT)
    return spread(pack_vectors(panel, low, high, "close"), tasks, "symbol").mapInPandas(
        fit, schema)


def lagged_closes(panel: DataFrame, n_lags: int = 3) -> DataFrame:
    """Close with its ``n_lags`` predecessors, oldest first as x1..xn."""
    lags = [F.lag("close", n_lags - k).over(by_t()).alias(f"x{k + 1}") for k in range(n_lags)]
    return panel.select("t", "symbol", *lags, F.col("close").alias("y")).dropna()


def pooled_coefficients(panel: DataFrame, plan: StepPlan, config: BacktestConfig) -> DataFrame:
    """Least squares of close on its last three closes, pooled over symbols, per step.

    Second moments fold to one row per date, step windows are joined to those rows, and
    the normal equations of each step are solved on one row.
    """
    names = ["x1", "x2", "x3", "y"]
    rows = lagged_closes(panel)
    # A fixed shift keeps the second moments small; it does not change the fit.
    shift = slice_range(panel, plan.train_start, plan.initial_end).agg(F.avg("close")).first()[0]
    rows = rows.withColumns({n: F.col(n) - shift for n in names})
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = [F.count("*").cast("double").alias("n"), *[F.sum(n).alias(f"s_{n}") for n in names],
            *[F.sum(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for a, b in pairs]]
    daily = rows.groupBy("t").agg(*sums)
    first = plan.train_start + config.lookback
    steps = plan.frame(panel.sparkSession).select(
        "step", (F.col("test_t") - config.val_days - 1).alias("last_train"),
        F.lit(first).alias("first_train"))
    totals = [c for c in daily.columns if c != "t"]
    moments = rows_in_windows(daily, steps, "first_train", "last_train") \
        .groupBy("step").agg(*[F.sum(c).alias(c) for c in totals])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                mean = {n: row[f"s_{n}"] / row["n"] for n in names}

                def cov(a: str, b: str) -> float:
                    key = f"s_{a}_{b}" if f"s_{a}_{b}" in row else f"s_{b}_{a}"
                    return row[key] / row["n"] - mean[a] * mean[b]

                xs = names[:3]
                lhs = np.array([[cov(a, b) for b in xs] for a in xs])
                coef = np.linalg.lstsq(lhs, np.array([cov(a, "y") for a in xs]), rcond=None)[0]
                intercept = mean["y"] + shift - sum(
                    c * (mean[n] + shift) for c, n in zip(coef, xs))
                out.append((row["step"], *coef, intercept))
            yield pd.DataFrame(out, columns=["step", "b1", "b2", "b3", "intercept"]) \
                .astype({"step": "int32"})

    return moments.mapInPandas(solve, "step int, b1 double, b2 double, b3 double, "
                                      "intercept double")


def pooled_regression(panel: DataFrame, plan: StepPlan, config: BacktestConfig) -> DataFrame:
    """Predicted close per step and symbol from the pooled coefficients."""
    coefficients = pooled_coefficients(panel, plan, config)
    steps = plan.frame(panel.sparkSession).select("step", F.col("test_t").alias("t"))
    test = lagged_closes(panel).join(F.broadcast(steps), "t")
    # One row per step.
    joined = test.join(F.broadcast(coefficients), "step")
    pred = F.col("intercept") + sum(
        (F.col(f"b{k}") * F.col(f"x{k}") for k in (1, 2, 3)), F.lit(0.0))
    return joined.select("step", "symbol", F.col("y").alias("target"),
                         F.col("x3").alias("last_close"), pred.alias("pred_close"))


def collect_predictions(samples: DataFrame, predicted: DataFrame, plan: StepPlan,
                        model: str) -> DataFrame:
    """Long forecast rows: prediction = last close + predicted residual at each test date."""
    steps = plan.frame(samples.sparkSession).select("step", F.col("test_t").alias("t"))
    test = samples.select("t", "date", "symbol", "target", "last_close") \
        .join(F.broadcast(steps), "t")
    return test.join(predicted, ["step", "symbol"]).select(
        F.lit(model).alias("model"), "step", "date", F.col("symbol").alias("ticker"),
        F.col("target").alias("y_true"),
        (F.col("last_close") + F.col("pred_residual")).alias("y_pred"), "last_close")


def blend_candidates(validation: DataFrame, alphas: tuple[float, ...]) -> DataFrame:
    """Validation error of (1 - a) * p1 + a * p2 per step and a.

    ``validation`` has ``(step, y_true, p1, p2)``.
    """
    errors = [F.avg(F.pow(F.col("y_true") - (1 - a) * F.col("p1") - a * F.col("p2"), 2))
              .alias(f"mse_{k}") for k, a in enumerate(alphas)]
    wide = validation.groupBy("step").agg(*errors)
    cells = F.array(*[F.struct(F.lit(a).alias("alpha"), F.col(f"mse_{k}").alias("mse"))
                      for k, a in enumerate(alphas)])
    return wide.select("step", F.explode(cells).alias("c")).select("step", "c.alpha", "c.mse")


def blend_errors(rows: DataFrame, steps: DataFrame, low: str, high: str,
                 alphas: tuple[float, ...]) -> DataFrame:
    """``blend_candidates`` of the rows (t, y_true, p1, p2) in each step's window.

    Squared errors fold to one row per date first; the steps see those only. A date without a known
    prediction adds nothing.
    """
    errors = [F.sum(F.pow(F.col("y_true") - (1 - a) * F.col("p1") - a * F.col("p2"), 2)).alias(f"e_{k}")
              for k, a in enumerate(alphas)]
    known = F.count(F.col("y_true") + F.col("p1") + F.col("p2")).alias("n")
    daily = rows.groupBy("t").agg(known, *errors)
    windows = rows_in_windows(daily, steps.select("step", low, high), low, high)
    wide = windows.groupBy("step").agg(F.sum("n").alias("n"), *(
        F.sum(f"e_{k}").alias(f"e_{k}") for k in range(len(alphas))))
    cells = F.array(*(F.struct(F.lit(a).alias("alpha"), (F.col(f"e_{k}") / F.col("n")).alias("mse"))
                      for k, a in enumerate(alphas)))
    return wide.select("step", F.explode(cells).alias("c")).select("step", "c.alpha", "c.mse")


def best_blend(candidates: DataFrame) -> DataFrame:
    """Smallest error per step; among equals the first, that is smallest, alpha."""
    best = candidates.groupBy("step").agg(F.min(F.struct("mse", "alpha")).alias("best"))
    return best.select("step", "best.alpha", "best.mse")


def apply_blend(test: DataFrame, best: DataFrame) -> DataFrame:
    blended = (1 - F.col("alpha")) * F.col("p1") + F.col("alpha") * F.col("p2")
    return test.join(F.broadcast(best.select("step", "alpha")), "step") \
        .withColumn("y_pred", blended)
