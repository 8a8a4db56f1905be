"""Pairwise statistics of symbols, computed in tiles.

Joining the panel to itself by date would emit dates x symbols^2 / 2 rows. Instead
symbols are hashed into blocks and each task gets two blocks with their value vectors:
a row travels once per block, and only the pairs that pass the thresholds leave a task.
A task holds at most about 2 x BLOCK vectors, however many symbols there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.config import GraphConfig
from barloom.operators.samples import StepPlan, slice_range

BLOCK = 128
STEPS_PER_TILE = 64
MAX_PARTITIONS = 20_000
PAIR_SCHEMA = ("step int, a string, b string, corr double, both_up double, both_down double, "
               "up_a double, up_b double, down_a double, down_b double")
# More than rounding to the graph's decimals can move a value.
SLACK = 1e-11


def pack_vectors(panel: DataFrame, start: int, end: int, value: str) -> DataFrame:
    """One row per symbol: its values over t in [start, end] in time order.

    The vector is bounded by the calendar, because symbol and t are unique together.
    """
    points = slice_range(panel, start, end).select("symbol", F.struct("t", value).alias("point"))
    ordered = points.groupBy("symbol").agg(F.array_sort(F.collect_list("point")).alias("points"))
    return ordered.select("symbol", F.col(f"points.{value}").alias("vec"))


def count_symbols(panel: DataFrame, t: int) -> int:
    """Every symbol is present on every common date, so one date counts the symbols."""
    return slice_range(panel, t, t).count()


def spread(groups: DataFrame, n_groups: int, *keys: str) -> DataFrame:
    """Hash groups over about twice as many partitions.

    The groups are small but costly to compute, so they must not be merged by size, as
    the planner would do with an exchange of its own. A grouping on the same keys that
    follows needs no further exchange.
    """
    return groups.repartition(max(1, min(2 * n_groups, MAX_PARTITIONS)), *keys)


def to_tiles(vectors: DataFrame, n_blocks: int, n_chunks: int) -> DataFrame:
    """Copy each vector to every tile (block pair, step chunk) that needs it."""
    block = F.pmod(F.xxhash64("symbol"), F.lit(n_blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    chunk = F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)))
    return vectors.withColumn("block", block).withColumn("other", other) \
        .withColumn("chunk", chunk).select(
            F.least("block", "other").alias("row_block"),
            F.greatest("block", "other").alias("col_block"), "chunk", "block", "symbol", "vec")


def window_products(x: np.ndarray, y: np.ndarray, windows: list[tuple[int, int]]
                    ) -> Iterator[np.ndarray]:
    """x[:, a:b + 1] @ y[:, a:b + 1].T for windows (a, b) whose ends do not fall from one to the next.

    What all windows of a group have in common is multiplied once; what the earlier ones reach back
    further and the later ones reach further on is summed up day by day from there. So a day is
    multiplied about once however long the windows are, and nothing is ever subtracted.
    """
    k = 0
    while k < len(windows):
        # The windows that share at least a day with the first of the group.
        stop = k + 1
        while stop < len(windows) and windows[stop][0] <= windows[k][1]:
            stop += 1
        group = windows[k:stop]
        low, high = group[-1][0], group[0][1]
        total = x[:, low:high + 1] @ y[:, low:high + 1].T
        back = [np.zeros_like(total)]
        for (a, _), (b, _) in zip(group[-2::-1], group[:0:-1]):
            back.append(back[-1] + x[:, a:b] @ y[:, a:b].T if a < b else back[-1])
        ahead = high
        for (_, end), before in zip(group, back[::-1]):
            if end > ahead:
                total = total + x[:, ahead + 1:end + 1] @ y[:, ahead + 1:end + 1].T
                ahead = end
            yield before + total
        k = stop


class Side:
    """Moments of one block's series over each window of a tile."""

    def __init__(self, values: np.ndarray, windows: list[tuple[int, int]]):
        # Shifted by a mean, so that little is lost when the window's own mean is taken out.
        self.values = values - values.mean(axis=1, keepdims=True)
        self.up, self.down = (values > 0).astype(float), (values < 0).astype(float)
        ones = np.ones((1, values.shape[1]))

        def sums(of: np.ndarray) -> list[np.ndarray]:
            return [s[:, 0] for s in window_products(of, ones, windows)]
        self.total, self.squares = sums(self.values), sums(self.values ** 2)
        self.ups, self.downs = sums(self.up), sums(self.down)
        # A series is constant in a window if it never changes after the window's first day.
        changes = np.zeros_like(values)
        changes[:, 1:] = values[:, 1:] != values[:, :-1]
        counted = np.cumsum(changes, axis=1)
        self.still = [counted[:, b] == counted[:, a] for a, b in windows]

    def spread(self, k: int, n: int) -> np.ndarray:
        """Root of the squared deviations in window k; 0 for a constant series."""
        dev = np.maximum(self.squares[k] - self.total[k] ** 2 / n, 0.0)
        return np.where(self.still[k], 0.0, np.sqrt(dev))


def _best_of_each(weight: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k largest allowed weights of each row, and of all that rounding may call equal."""
    held = np.where(allowed, weight, -np.inf)
    if held.shape[1] <= k:
        return allowed
    limit = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
    return allowed & (held >= (limit - SLACK * np.maximum(1.0, np.abs(limit)))[:, None])


def leading_pairs(stats: dict[str, np.ndarray], config: GraphConfig, apart: np.ndarray) -> np.ndarray:
    """Mask of pairs among the heaviest of either end in the tile, for either graph.

    A neighbour that is among the k heaviest of all is among those of its tile. The largest lift of a
    step is the heaviest of its own source and so stays too: weights relative to it do not change.
    """
    kept = np.zeros(apart.shape, dtype=bool)
    corr = np.where(np.isfinite(stats["corr"]), np.abs(stats["corr"]), 0.0)
    linked = apart & (corr >= config.pearson_threshold - SLACK)
    for weight, mask, turn in ((corr, linked, False), (corr.T, linked.T, True)):
        best = _best_of_each(weight, mask, config.pearson_topk)
        kept |= best.T if turn else best
    for src, dst, turn in (("a", "b", False), ("b", "a", True)):
        rule = association_limits(stats, src, dst, config)
        lift, mask = rule[0], apart & rule[1]
        best = _best_of_each(lift.T if turn else lift, mask.T if turn else mask, config.assoc_topk)
        kept |= best.T if turn else best
    return kept


def association(both: np.ndarray, p_src: np.ndarray, p_dst: np.ndarray):
    """Support, confidence and lift of co-movement, with the 1e-8 guard in denominators."""
    return both, both / (p_src + 1e-8), both / (p_src * p_dst + 1e-8)


def association_limits(s: dict[str, np.ndarray], src: str, dst: str, config: GraphConfig
                       ) -> tuple[np.ndarray, np.ndarray]:
    """(lift, mask of rules from ``src`` to ``dst`` that can pass the three limits)."""
    support = np.maximum(s["both_up"], s["both_down"])
    _, conf_up, lift_up = association(s["both_up"], s[f"up_{src}"], s[f"up_{dst}"])
    _, conf_down, lift_down = association(s["both_down"], s[f"down_{src}"], s[f"down_{dst}"])
    lift = np.maximum(lift_up, lift_down)
    return lift, ((support >= config.min_support - SLACK)
                  & (np.maximum(conf_up, conf_down) >= config.min_confidence - SLACK)
                  & (lift >= config.lift_threshold - SLACK))


def pair_filter(config: GraphConfig) -> Callable[[dict[str, np.ndarray]], np.ndarray]:
    """Mask of pairs that can reach either graph in at least one direction.

    The graph compares rounded values, so the limits are lowered by ``SLACK`` here: the mask
    keeps all that the graph keeps, which has the last word.
    """
    def keep(s: dict[str, np.ndarray]) -> np.ndarray:
        passes = np.abs(s["corr"]) >= config.pearson_threshold - SLACK
        for src, dst in (("a", "b"), ("b", "a")):
            passes |= association_limits(s, src, dst, config)[1]
        return passes
    return keep


def _tile_frames(rows: pd.DataFrame, windows, offset: int, keep, topk) -> Iterator[pd.DataFrame]:
    """Surviving pairs of one tile, a frame per step."""
    key = rows.iloc[0]
    left = rows[rows["block"] == key["row_block"]]
    right = rows[rows["block"] == key["col_block"]]
    if left.empty or right.empty:
        return
    names_l, names_r = left["symbol"].to_numpy(), right["symbol"].to_numpy()
    x, y = np.stack(left["vec"].to_numpy()), np.stack(right["vec"].to_numpy())
    in_order = names_l[:, None] < names_r[None, :]
    same_block = key["row_block"] == key["col_block"]
    spans = [(start - offset, end - offset) for _, start, end in windows]
    left_side, right_side = Side(x, spans), Side(y, spans)
    crossed = zip(*(window_products(getattr(left_side, name), getattr(right_side, name), spans)
                    for name in ("values", "up", "down")))
    for k, ((step, start, end), (cross, both_up, both_down)) in enumerate(zip(windows, crossed)):
        n = end - start + 1
        scale = left_side.spread(k, n)[:, None] * right_side.spread(k, n)[None, :]
        cov = cross - left_side.total[k][:, None] * right_side.total[k][None, :] / n
        stats = {"corr": np.divide(cov, scale, out=np.zeros_like(cov), where=scale > 0),
                 "both_up": both_up / n, "both_down": both_down / n,
                 "up_a": left_side.ups[k][:, None] / n, "up_b": right_side.ups[k][None, :] / n,
                 "down_a": left_side.downs[k][:, None] / n, "down_b": right_side.downs[k][None, :] / n}
        # A block met with itself holds each pair twice.
        wanted = in_order if same_block else np.ones(in_order.shape, dtype=bool)
        if topk:
            wanted = wanted & leading_pairs(stats, topk, names_l[:, None] != names_r[None, :])
        i, j = np.nonzero(wanted & keep(stats) if keep else wanted)
        ordered = in_order[i, j]
        out = {"step": np.full(len(i), step, dtype=np.int32),
               "a": np.where(ordered, names_l[i], names_r[j]),
               "b": np.where(ordered, names_r[j], names_l[i])}
        out |= {name: stats[name][i, j] for name in ("corr", "both_up", "both_down")}
        for move in ("up", "down"):
            of_l, of_r = stats[f"{move}_a"][i, 0], stats[f"{move}_b"][0, j]
            out[f"{move}_a"] = np.where(ordered, of_l, of_r)
            out[f"{move}_b"] = np.where(ordered, of_r, of_l)
        yield pd.DataFrame(out)


def pair_statistics(panel: DataFrame, plan: StepPlan, recent_days: int,
                    config: GraphConfig | None = None, block: int = BLOCK,
                    leading: bool = False) -> DataFrame:
    """Pearson correlation and co-movement shares of symbol pairs (a < b) per step.

    ``panel`` holds raw returns on common dates. With ``config`` only pairs that can
    pass one of its graphs are returned; without, all pairs are. With ``leading`` too, a task
    keeps only what may be among the heaviest of an end, at most some 2 (pearson_topk + assoc_topk)
    pairs per symbol, step and tile: enough for the graphs, but not for all edges above a threshold.
    """
    windows = plan.windows(recent_days)
    low, high = min(w[1] for w in windows), max(w[2] for w in windows)
    n_blocks = max(1, math.ceil(count_symbols(panel, high) / block))
    chunks = [windows[k:k + STEPS_PER_TILE] for k in range(0, len(windows), STEPS_PER_TILE)]
    keep, topk = pair_filter(config) if config else None, config if leading else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches))
        yield from _tile_frames(rows, chunks[int(rows["chunk"].iloc[0])], low, keep, topk)

    keys = ["row_block", "col_block", "chunk"]
    tiles = to_tiles(pack_vectors(panel, low, high, "ret"), n_blocks, len(chunks))
    n_tiles = n_blocks * (n_blocks + 1) // 2 * len(chunks)
    return spread(tiles, n_tiles, *keys).groupBy(*keys).applyInPandas(run, PAIR_SCHEMA)
