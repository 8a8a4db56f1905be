"""Keyed upsert of prediction rows; ``run_store`` keeps them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["prediction_run_id", "ticker"]


def last_per_key(incoming: DataFrame, keys: list[str] = KEYS,
                 position: str = "position") -> DataFrame:
    """The later of two incoming rows with one key wins; folds map-side."""
    others = [c for c in incoming.columns if c not in keys and c != position]
    newest = F.max_by(F.struct(*others), F.col(position)).alias("row")
    return incoming.groupBy(*keys).agg(newest).select(*keys, "row.*") \
        .select(*[c for c in incoming.columns if c != position])


def upsert_rows(target: DataFrame, incoming: DataFrame, keys: list[str] = KEYS,
                position: str = "position", now: Column | None = None) -> DataFrame:
    """Target rows without an incoming key, plus the incoming rows.

    Incoming rows take ``created_at`` = now when it is given.
    """
    fresh = last_per_key(incoming, keys, position)
    if now is not None:
        fresh = fresh.withColumn("created_at", now)
    return target.join(fresh.select(*keys), keys, "left_anti").unionByName(
        fresh.select(*target.columns))
