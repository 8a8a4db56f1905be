"""Scalar columns: parsing, coercion, forecast arithmetic and report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Confidence tiers of the graph gate.
HIGH_GATE = 0.6
MEDIUM_GATE = 0.3
MIN_ABS_CLOSE = 1e-12
DASH = "—"


def to_number(text: Column | str) -> Column:
    """Text to double; anything that is not a finite number becomes NULL."""
    value = F.expr("try_cast({} as double)".format(text)) if isinstance(text, str) \
        else text.try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def symbol_list(text: Column | str) -> Column:
    """Comma list to trimmed upper-case symbols, blanks dropped."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.transform(F.split(text, ","), lambda s: F.upper(F.trim(s)))
    return F.filter(parts, lambda s: s != "")


def utc_date(ts: Column | str) -> Column:
    return F.to_date(ts)


def price_change(pred: str = "pred_close", last: str = "last_close") -> Column:
    return F.col(pred) - F.col(last)


def sign_class(value: Column) -> Column:
    return F.when(value > 0, "positive").when(value < 0, "negative").otherwise("neutral")


def predicted_return(pred: str = "pred_close", last: str = "last_close") -> Column:
    base = F.abs(F.col(last))
    return F.when(base > MIN_ABS_CLOSE, F.try_divide(F.col(pred) - F.col(last), base))


def zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def confidence_tier(gate: str = "graph_gate") -> Column:
    value = zero_if_null(gate)
    return F.when(value > HIGH_GATE, "High").when(value >= MEDIUM_GATE, "Medium").otherwise("Low")


def _fixed(value: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f", value)


def number_text(name: str, decimals: int = 4) -> Column:
    value = F.col(name)
    return F.when(value.isNull() | F.isnan(value), DASH).otherwise(_fixed(value, decimals))


def percent_text(name: str) -> Column:
    value = F.col(name)
    return F.when(value.isNull() | F.isnan(value), DASH) \
        .otherwise(F.concat(_fixed(value * 100, 4), F.lit("%")))


def signed_text(value: Column, decimals: int = 6) -> Column:
    return F.when(value.isNull(), DASH) \
        .otherwise(F.concat(F.when(value > 0, "+").otherwise(""), _fixed(value, decimals)))


def utc_text(name: str) -> Column:
    return F.coalesce(F.date_format(name, "yyyy-MM-dd HH:mm:ss 'UTC'"), F.lit(DASH))
