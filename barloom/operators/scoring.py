"""Scoring snapshots with a user-supplied scorer and shaping prediction rows."""

from __future__ import annotations

from datetime import datetime, timezone

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalars import predicted_return

# A scorer maps arrays (sequences [n, L], nodes [n, F], last closes [n]) to n closes.
Scorer = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
SCORED = "snapshot string, as_of_date date, ticker string, last_close double, pred_close double"


def naive_scorer(seq: np.ndarray, node: np.ndarray, last: np.ndarray) -> np.ndarray:
    return last


def linear_scorer(coefficients: np.ndarray, intercept: float) -> Scorer:
    """Last close plus a residual that is linear in the sequence."""
    def score(seq: np.ndarray, node: np.ndarray, last: np.ndarray) -> np.ndarray:
        return last + intercept + seq @ coefficients
    return score


def score_rows(snapshots: DataFrame, scorer: Scorer) -> DataFrame:
    """Score rows in Arrow batches.

    ``snapshots``: (snapshot, as_of_date, symbol, seq, node, last_close). A scorer that
    needs a symbol's neighbours takes them as node columns (``graph.neighbour_sums``), so
    no task has to hold all symbols of a snapshot.
    """
    def run(batches):
        for batch in batches:
            if len(batch):
                yield _score(batch, scorer)
    return _shape(snapshots.mapInPandas(run, SCORED))


def _score(rows: pd.DataFrame, scorer: Scorer) -> pd.DataFrame:
    last = rows["last_close"].to_numpy()
    pred = scorer(np.stack(rows["seq"].to_numpy()), np.stack(rows["node"].to_numpy()), last)
    return pd.DataFrame({"snapshot": rows["snapshot"], "as_of_date": rows["as_of_date"],
                         "ticker": rows["symbol"], "last_close": last, "pred_close": pred})


def _shape(scored: DataFrame) -> DataFrame:
    return scored.withColumn("pred_return", predicted_return()) \
        .withColumn("graph_gate", F.lit(None).cast("double"))


def run_id(prefix: str, at: Column | None = None) -> Column:
    """``prefix`` and a time stamp; without ``at`` the driver's clock, read once, so that every
    evaluation of a plan names the same run."""
    if at is None:
        return F.lit(f"{prefix}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}")
    return F.concat(F.lit(prefix), F.lit("_"), F.date_format(at, "yyyyMMdd_HHmmss"))


LINEAGE = ["checkpoint_path", "input_npz_path", "output_json_path", "device"]


def stored_run(rows: DataFrame, model_name: str, run: str | Column,
               created_at: Column | None = None) -> DataFrame:
    """Prediction rows in the shape of the predictions table.

    Rows may come from the scorer or from prediction documents; lineage fields that
    the rows lack stay NULL.
    """
    known = {"checkpoint_path": "checkpoint", "input_npz_path": "input_npz",
             "output_json_path": "output_json", "device": "device"}
    lineage = [(F.col(known[c]) if known[c] in rows.columns else F.lit(None).cast("string"))
               .alias(c) for c in LINEAGE]
    position = F.col("position") if "position" in rows.columns else F.lit(0)
    return rows.select(
        (F.lit(run) if isinstance(run, str) else run).alias("prediction_run_id"),
        "as_of_date", F.lit(model_name).alias("model_name"), *lineage, "ticker", "last_close",
        "pred_close", "pred_return", "graph_gate",
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
        position.alias("position"))
