"""Backtest plan, lookback samples and train/validation/test splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.config import BacktestConfig
from barloom.guards import require_dates, require_samples
from barloom.operators.calendar import count_dates, first_dates_from
from barloom.operators.features import FEATURE_COLUMNS

def by_t() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("t")


@dataclass(frozen=True)
class StepPlan:
    """Expanding steps: one per test date, training start fixed, training end = test - 1."""

    first_test: int
    n_steps: int
    train_start: int

    @property
    def initial_end(self) -> int:
        return self.first_test - 1

    def windows(self, recent_days: int | None = None) -> list[tuple[int, int, int]]:
        """(step, start, end) training windows, cut to the recent days when given."""
        out = []
        for step in range(1, self.n_steps + 1):
            end = self.first_test + step - 2
            start = self.train_start
            if recent_days is not None:
                start = max(start, end - recent_days + 1)
            out.append((step, start, end))
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        step = F.col("id").cast("int")
        test_t = (F.lit(self.first_test - 1) + step).cast("int")
        return spark.range(1, self.n_steps + 1, numPartitions=1).select(
            step.alias("step"), test_t.alias("test_t"),
            F.lit(self.train_start).alias("train_start"), (test_t - 1).alias("train_end"))


def plan_steps(calendar: DataFrame, config: BacktestConfig) -> StepPlan:
    """Steps over the last ``test_days`` common dates."""
    n_dates = require_dates(count_dates(calendar), max(config.lookback, config.test_days))
    first = n_dates - config.test_days
    return _plan(first, config.test_days, config)


def plan_forward(calendar: DataFrame, start_date: str, config: BacktestConfig) -> StepPlan:
    """Steps over the first ``test_days`` common dates from ``start_date``."""
    chosen = first_dates_from(calendar, start_date, config.test_days)
    first = chosen.agg(F.min("t")).first()[0]
    return _plan(first, config.test_days, config)


def _plan(first: int, n_steps: int, config: BacktestConfig) -> StepPlan:
    start = max(0, first - config.initial_train)
    require_samples(first - start - config.lookback, config.val_days)
    return StepPlan(first, n_steps, start)


def dated_steps(plan: StepPlan, calendar: DataFrame) -> DataFrame:
    steps = plan.frame(calendar.sparkSession)
    dates = calendar.select(F.col("t").alias("test_t"), F.col("date").alias("test_date"))
    return dates.join(F.broadcast(steps), "test_t")


def rows_in_windows(rows: DataFrame, steps: DataFrame, low: str, high: str) -> DataFrame:
    """Rows (by t) of each step's window, low to high, with the step's columns.

    The windows are spelt out by date, so that a hash lookup finds a row's steps. That table has at
    most test days x calendar days rows. A row is returned once per step: where only totals are
    wanted, ``window_totals`` does not multiply rows.
    """
    days = steps.withColumn("t", F.explode(F.sequence(F.col(low), F.col(high))))
    return rows.join(F.broadcast(days), "t")


def window_totals(rows: DataFrame, keys: list[str], steps: DataFrame, low: str, high: str,
                  measures: dict[str, Column]) -> DataFrame:
    """``(step, *keys, *measures)``: sum of each measure over t in the step's window, low to high.

    A window is the running sum at its last day less that before its first, so rows are summed once
    whatever the number and length of windows, and only two rows per key and step leave the table.
    Keys must have a row on each day from their first to their last, once a day; a null measure counts
    as 0. Keys without a row in a window total 0 there if they had one before, else have no row.
    """
    running = Window.partitionBy(*keys).orderBy("t").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    totals = rows.select("t", *keys, *(
        F.sum(F.coalesce(m, F.lit(0))).over(running).alias(n) for n, m in measures.items()))
    # Two rows per test day.
    ends = steps.select("step", F.explode(F.array(
        F.struct(F.col(high).cast("int").alias("t"), F.lit(1).alias("sign")),
        F.struct((F.col(low) - 1).cast("int").alias("t"), F.lit(-1).alias("sign")))).alias("e")) \
        .select("step", "e.*")
    return totals.join(F.broadcast(ends), "t").groupBy("step", *keys).agg(
        *(F.sum(F.col("sign") * F.col(n)).alias(n) for n in measures))


def slice_range(panel: DataFrame, start: int, end: int) -> DataFrame:
    return panel.filter(F.col("t").between(start, end))


def build_samples(panel: DataFrame, lookback: int,
                  columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Training samples for every t: closes t-L..t-1, feature vector at t-1, target at t.

    t is dense, so the frame is full exactly when t >= lookback.
    """
    frame = by_t().rowsBetween(-lookback, -1)
    node = F.array(*columns)
    return panel.select(
        "t", "date", "symbol",
        F.collect_list("close").over(frame).alias("seq"),
        F.lag(node).over(by_t()).alias("node"),
        F.lag("close").over(by_t()).alias("last_close"),
        F.col("close").alias("target")) \
        .filter(F.size("seq") == lookback) \
        .withColumn("residual", F.col("target") - F.col("last_close"))


def serving_sequences(panel: DataFrame, lookback: int,
                      columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Serving samples: closes t-L+1..t and the feature vector at t itself."""
    frame = by_t().rowsBetween(1 - lookback, Window.currentRow)
    return panel.select(
        "t", "date", "symbol", F.collect_list("close").over(frame).alias("seq"),
        F.array(*columns).alias("node"), F.col("close").alias("last_close")) \
        .filter(F.size("seq") == lookback)


def sample_range(samples: DataFrame, start: int, end: int) -> DataFrame:
    return slice_range(samples, start, end)


def split_samples(samples: DataFrame, steps: DataFrame, config: BacktestConfig) -> DataFrame:
    """Attach (step, split) to samples.

    One sample row serves many steps, so call this on narrow rows (keys, or the few
    columns a job needs) and join sequences late. The last ``val_days`` samples before
    the test date are validation; t is dense, so that is a comparison, not a ranking.
    """
    windows = steps.withColumn("first_sample", F.col("train_start") + config.lookback)
    joined = rows_in_windows(samples, windows, "first_sample", "test_t")
    split = F.when(F.col("t") == F.col("test_t"), "test") \
        .when(F.col("t") > F.col("train_end") - config.val_days, "val").otherwise("train")
    return joined.withColumn("split", split).drop("first_sample")


def latest_split(samples: DataFrame, val_days: int) -> DataFrame:
    """One pack: the last sample is the test, the ``val_days`` before it validation."""
    last = samples.agg(F.max("t")).scalar()
    split = F.when(F.col("t") == last, "test") \
        .when(F.col("t") >= last - val_days, "val").otherwise("train")
    return samples.withColumn("split", split)
