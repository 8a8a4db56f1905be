"""Daily bars: cleaning, forward fill, and the merge of a newest tick."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BAR_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume"]


def by_date() -> WindowSpec:
    """A symbol's bars in time order.

    There is at most one bar per symbol and date (``guards.require_daily_key``), so no
    window is longer than the calendar, whatever share of all rows a symbol has.
    """
    return Window.partitionBy("symbol").orderBy("date")


def nan_to_null(df: DataFrame) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(*[
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in doubles else F.col(c) for c in df.columns
    ])


def forward_fill(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace NULL by the newest earlier value of the same symbol."""
    window = by_date().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})


def clean_bars(bars: DataFrame) -> DataFrame:
    """Fill close; open, high and low fall back to close; volume to 0; drop rows without close."""
    filled = forward_fill(nan_to_null(bars), ["close"])
    prices = {c: F.coalesce(c, "close") for c in ("open", "high", "low")}
    return filled.withColumns({**prices, "volume": F.coalesce("volume", F.lit(0.0))}) \
        .dropna(subset=["close"]).select(*BAR_COLUMNS)


def tick_actions(bars: DataFrame, ticks: DataFrame,
                 late_policy: str = "overwrite_last") -> DataFrame:
    """Bars with what their symbol's tick does to the history.

    ``action`` is ``overwrite`` (a bar of the event date exists), ``append`` (newer than
    the last bar) or ``overwrite_last`` (older and absent); NULL without a tick.
    """
    if late_policy not in ("overwrite_last", "ignore"):
        raise ValueError(f"unknown late policy {late_policy}")
    tick = ticks.select("symbol", F.col("price").alias("tick_price"),
                        F.to_date("event_time").alias("event_date"))
    whole = Window.partitionBy("symbol")
    facts = bars.select(*BAR_COLUMNS).join(tick, "symbol", "left").withColumns({
        "last_date": F.max("date").over(whole),
        "last_volume": F.max_by("volume", "date").over(whole),
        "known_date": F.max(F.col("date") == F.col("event_date")).over(whole)})
    action = F.when(F.col("event_date").isNull(), F.lit(None)) \
        .when(F.col("known_date"), "overwrite") \
        .when(F.col("event_date") > F.col("last_date"), "append").otherwise(late_policy)
    target = F.when(F.col("action") == "overwrite_last", F.col("last_date")) \
        .when(F.col("action") == "overwrite", F.col("event_date"))
    return facts.withColumn("action", action).withColumn("target_date", target)


def merge_ticks(bars: DataFrame, ticks: DataFrame,
                late_policy: str = "overwrite_last") -> DataFrame:
    """Bars with each symbol's newest tick applied; ``ticks`` has one row per symbol.

    One pass over the bars: the newest bar of a symbol also gives off the appended one.
    Rows stay partitioned by symbol, as the feature windows want them.
    """
    price, hit = F.col("tick_price"), F.col("date") == F.col("target_date")
    quotes = ("open", "high", "low", "close")
    kept = F.struct("date", *[
        F.when(hit, price).otherwise(F.col(c)).alias(c) for c in quotes],
        F.when(hit, F.coalesce("volume", "last_volume")).otherwise(F.col("volume"))
        .alias("volume"))
    added = F.struct(F.col("event_date").alias("date"), *[
        price.alias(c) for c in quotes], F.coalesce("last_volume", F.lit(0.0)).alias("volume"))
    is_new = (F.col("action") == "append") & (F.col("date") == F.col("last_date"))
    rows = F.array_compact(F.array(kept, F.when(is_new, added)))
    return tick_actions(bars, ticks, late_policy) \
        .select("symbol", F.explode(rows).alias("bar")).select("symbol", "bar.*")


def newest_close(bars: DataFrame) -> DataFrame:
    """Close of each symbol's last bar; symbols whose last close is missing drop out."""
    return nan_to_null(bars).groupBy("symbol") \
        .agg(F.max("date").alias("date"), F.max_by("close", "date").alias("price")) \
        .filter(F.col("price").isNotNull())
