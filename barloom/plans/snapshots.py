"""Serving snapshots: the newest sample of every symbol, and the graph beside it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.config import GraphConfig
from barloom.guards import require_dates, require_rows
from barloom.operators.bars import merge_ticks
from barloom.operators.calendar import aligned_panel, count_dates, long_enough
from barloom.operators.features import FEATURE_COLUMNS, engineer_features
from barloom.operators.graph import build_graph, snapshot_plan
from barloom.operators.samples import serving_sequences
from barloom.operators.scaling import apply_minmax
from barloom.operators.ticks import latest_ticks
from barloom.session import stage


@dataclass(frozen=True)
class Snapshot:
    """An aligned panel seen at its last common date."""

    panel: DataFrame
    n_dates: int
    lookback: int
    as_of: Column | None = None

    def rows(self, scaler: DataFrame | None = None) -> DataFrame:
        """``(as_of_date, symbol, seq, node, last_close)``; raw unless a scaler is given."""
        last = self.n_dates - 1
        recent = self.panel.filter(F.col("t") > last - self.lookback)
        if scaler is not None:
            recent = apply_minmax(recent, scaler, FEATURE_COLUMNS)
        as_of = self.as_of if self.as_of is not None else F.col("date")
        return serving_sequences(recent, self.lookback).filter(F.col("t") == last) \
            .select(as_of.alias("as_of_date"), "symbol", "seq", "node", "last_close")

    def graph(self, config: GraphConfig = GraphConfig()) -> DataFrame:
        """Edges over the recent dates, the last one included."""
        symbols = self.panel.filter(F.col("t") == self.n_dates - 1).select("symbol")
        plan = snapshot_plan(self.n_dates, config.recent_days)
        return build_graph(self.panel, symbols, plan, config)


def snapshot_from_history(bars: DataFrame, lookback: int) -> Snapshot:
    panel, calendar = aligned_panel(engineer_features(bars))
    return Snapshot(panel, require_dates(count_dates(calendar), lookback), lookback)


def snapshot_from_ticks(bars: DataFrame, ticks: DataFrame, lookback: int,
                        late_policy: str = "overwrite_last") -> Snapshot:
    """Snapshot after merging each symbol's newest tick into its history.

    Only symbols with both a tick and enough history take part; the as-of date is the
    greatest event date among them.
    """
    newest = require_rows(stage(latest_ticks(ticks), "ticks"), "latest ticks")
    ticked = bars.join(newest.select("symbol"), "symbol", "left_semi")
    merged = merge_ticks(ticked, newest, late_policy)
    features = stage(engineer_features(merged), "features")
    usable = require_rows(long_enough(features, lookback), "symbols with enough history")
    panel, calendar = aligned_panel(usable, stored=True)
    n_dates = require_dates(count_dates(calendar), lookback)
    as_of = newest.join(usable.select("symbol").distinct(), "symbol", "left_semi") \
        .agg(F.max(F.to_date("event_time"))).scalar()
    return Snapshot(panel, n_dates, lookback, as_of)
