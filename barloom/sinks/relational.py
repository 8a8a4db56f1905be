"""Relational sinks over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.guards import require_rows


def overwrite_table(df: DataFrame, options: dict[str, str]) -> None:
    """Replace a table; fails before touching it when there is nothing to write."""
    require_rows(df, "rows for " + options.get("dbtable", "table"))
    df.write.format("jdbc").options(**options).mode("overwrite").save()


def append_table(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("append").save()
