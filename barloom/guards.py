"""Input checks that stop a job with a clear message."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DataCheckError(ValueError):
    """An input does not meet what the operator needs."""


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise DataCheckError(f"{what} lacks required columns: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise DataCheckError(f"{what} has no rows")
    return df


def require_dates(n_dates: int, more_than: int) -> int:
    if n_dates <= more_than:
        raise DataCheckError(f"need more than {more_than} common dates, got {n_dates}")
    return n_dates


def require_samples(n_samples: int, val_days: int) -> int:
    if n_samples <= val_days:
        raise DataCheckError(
            f"need more than {val_days} training samples to cut off validation, got {n_samples}")
    return n_samples


def require_daily_key(bars: DataFrame) -> DataFrame:
    """Bars hold at most one row per symbol and date.

    This is also what bounds every per-symbol window: a symbol never has more
    rows than the calendar has days.
    """
    repeated = bars.groupBy("symbol", "date").count().filter(F.col("count") > 1)
    first = repeated.orderBy("symbol", "date").first()
    if first is not None:
        raise DataCheckError(f"several bars for {first['symbol']} on {first['date']}")
    return bars
