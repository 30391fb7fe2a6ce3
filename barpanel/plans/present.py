"""Presentation rules shared by the Spark queries and their SQL oracles:
which digits each column is rounded to, dates as ISO strings. Both engines
get the same rule so results compare value for value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE = 4   # price-scale values (prices, SMAs, EMAs, MACD)
RATIO = 6   # ratios, RSI, volatility, scaled values, probabilities
METRIC = 4  # evaluation metrics (the reference rounds them to 4)

DIGITS = {
    "open": PRICE, "high": PRICE, "low": PRICE, "close": PRICE,
    "sma_10": PRICE, "sma_20": PRICE, "sma_50": PRICE,
    "ema_12": PRICE, "ema_26": PRICE,
    "macd": PRICE, "macd_signal": PRICE, "macd_hist": PRICE,
    "delta": PRICE, "gain": PRICE, "loss": PRICE,
    "log_return": RATIO, "sma_10_ratio": RATIO, "sma_20_ratio": RATIO,
    "sma_50_ratio": RATIO, "rsi_14": RATIO, "volatility_20": RATIO,
    "volume_norm": RATIO,
}


def spark_round(df: DataFrame, digits: dict | None = None, date_cols=("date",),
                default: int | None = None) -> DataFrame:
    """Round double columns per ``digits`` and render date columns as text."""
    digits = {**DIGITS, **(digits or {})}
    out = []
    for name, typ in df.dtypes:
        c: Column = F.col(f"`{name}`")
        if name in date_cols or typ in ("date", "timestamp", "timestamp_ntz"):
            if typ == "date":
                c = F.date_format(c, "yyyy-MM-dd")
            elif typ in ("timestamp", "timestamp_ntz"):
                c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif typ in ("double", "float") and (name in digits or default is not None):
            c = F.round(c.cast("double"), digits.get(name, default))
        out.append(c.alias(name))
    return df.select(*out)


def sql_round(col: str, digits: dict | None = None, default: int | None = None,
              expr: str | None = None) -> str:
    d = {**DIGITS, **(digits or {})}.get(col, default)
    e = expr or col
    return f"round(({e})::double, {d}) as {col}" if d is not None else f"{e} as {col}"


def sql_date(col: str = "date", expr: str | None = None) -> str:
    return f"strftime({expr or col}, '%Y-%m-%d') as {col}"


def sql_ts(col: str = "date", expr: str | None = None) -> str:
    return f"strftime({expr or col}, '%Y-%m-%d %H:%M:%S') as {col}"
