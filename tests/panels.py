"""Small hand-made panels."""

import datetime as dt

import numpy as np

START = dt.date(2024, 1, 1)


def day(k):
    return START + dt.timedelta(days=k)


BAR_SCHEMA = ("symbol string, date date, open double, high double, low double, close double, "
              "volume double")


def bars(spark, closes: dict[str, list], days: dict[str, list[int]] | None = None):
    rows = []
    for symbol, values in closes.items():
        at = days[symbol] if days else range(len(values))
        for k, value in zip(map(int, at), values):
            price = None if value is None else float(value)
            rows.append((symbol, day(k), price, price, price, price, 10.0))
    return spark.createDataFrame(rows, BAR_SCHEMA)


def panel(spark, returns: np.ndarray, symbols: list[str], closes: np.ndarray | None = None):
    closes = closes if closes is not None else 100 * np.cumprod(1 + returns, axis=0)
    rows = [(t, day(t), s, float(returns[t, j]), float(closes[t, j]))
            for t in range(returns.shape[0]) for j, s in enumerate(symbols)]
    return spark.createDataFrame(rows, "t int, date date, symbol string, ret double, close double")


def correlated(n_dates, n_symbols, seed=0, groups=3, noise=0.3):
    """Returns in which symbols of one group move together."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n_dates, groups))
    own = rng.normal(size=(n_dates, n_symbols))
    return 0.01 * (base[:, np.arange(n_symbols) % groups] + noise * own)
