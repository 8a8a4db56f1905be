"""Comparable result columns for Spark and for the SQL checks.

A spec lists columns as ``name:kind``: f double (6 decimals), i long, d date text,
t timestamp text, and no kind for values taken as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Moves exact halves (prices in cents over a power of two) off the rounding edge, so
# both engines round them alike.
NUDGE = 1e-9


def _columns(spec: str) -> list[tuple[str, str]]:
    return [(c.partition(":")[0], c.partition(":")[2]) for c in spec.split()]


def present(df: DataFrame, spec: str) -> DataFrame:
    forms = {
        "f": lambda c: F.round(c.cast("double") + F.lit(NUDGE), 6) + F.lit(0.0),
        "i": lambda c: c.cast("long"),
        "d": lambda c: F.date_format(c, "yyyy-MM-dd"),
        "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "": lambda c: c,
    }
    return df.select(*[forms[kind](F.col(f"`{name}`")).alias(name)
                       for name, kind in _columns(spec)])


def wrap_sql(prefix: str, body: str, spec: str) -> str:
    forms = {
        "f": f"round(CAST({{c}} AS DOUBLE) + {NUDGE}, 6) + 0.0", "i": "CAST({c} AS BIGINT)",
        "d": "strftime({c}, '%Y-%m-%d')", "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
        "": "{c}",
    }
    cells = ", ".join(forms[kind].format(c=f'"{name}"') + f' AS "{name}"'
                      for name, kind in _columns(spec))
    return f"WITH {prefix}\nSELECT {cells} FROM (\n{body}\n) AS q"
