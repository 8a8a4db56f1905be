"""Technical features per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.guards import require_rows
from barloom.operators.bars import BAR_COLUMNS, by_date, forward_fill, nan_to_null

FEATURE_COLUMNS = ["close", "volume", "ret", "ma5", "ma20", "vol5", "vol20"]
PAPER_COLUMNS = ["open", "high", "low", "close", "volume"]


def simple_return(close: str = "close") -> Column:
    """Return against the previous bar: 0.0 on the first bar, NULL after a zero close.

    A second bar for one symbol and date stops the job: windows here rely on daily bars.
    """
    previous, previous_date = F.lag(close).over(by_date()), F.lag("date").over(by_date())
    twice = F.raise_error(F.concat(F.lit("several bars for "), "symbol", F.lit(" on "), "date"))
    change = F.try_divide(F.col(close), previous) - 1
    return F.when(previous_date.isNull(), F.lit(0.0)) \
        .when(previous_date == F.col("date"), twice.cast("double")).otherwise(change)


def rolling(name: str, size: int, measure=F.avg) -> Column:
    """Aggregate over the last ``size`` rows; NULL until the frame is full."""
    frame = by_date().rowsBetween(1 - size, Window.currentRow)
    return F.when(F.count(name).over(frame) == size, measure(name).over(frame))


def add_features(bars: DataFrame) -> DataFrame:
    """Return, moving averages and volatilities.

    All windows share one partitioning and order: one exchange, one sort.
    """
    return bars.withColumn("ret", simple_return()).withColumns({
        "ma5": rolling("close", 5), "ma20": rolling("close", 20),
        "vol5": rolling("ret", 5, F.stddev_samp), "vol20": rolling("ret", 20, F.stddev_samp)})


def engineer_features(bars: DataFrame, check: bool = False) -> DataFrame:
    """Features without the warm-up rows of each symbol."""
    out = add_features(bars).dropna()
    return require_rows(out, "engineered features") if check else out


def paper_features(bars: DataFrame) -> DataFrame:
    """Variant without moving averages: fill forward, then 0 for what is still missing."""
    base = nan_to_null(bars).select(*BAR_COLUMNS)
    change = F.try_divide(F.col("close"), F.lag("close").over(by_date())) - 1
    # pandas fills the close before taking the change, so the change uses filled closes.
    filled_close = forward_fill(base.withColumn("raw_close", F.col("close")), ["close"])
    out = forward_fill(filled_close.withColumn("ret", change),
                       ["open", "high", "low", "volume", "ret"])
    return out.drop("raw_close").fillna(0.0)
