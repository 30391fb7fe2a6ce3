"""Ordered per-series window operators.

Each function takes a frame prepared by a ``SeriesLayout`` and returns it with
new columns. Frames look back a bounded number of rows, so under the blocked
layout they are exact whenever the layout's halo covers the look-back
(``halo_rows`` below gives the need of the whole feature set).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barpanel.constants import (MACD_FAST_SPAN, MACD_SIGNAL_SPAN, MACD_SLOW_SPAN,
                                RSI_COM, TRADING_DAYS, VOL_WINDOW, VOLUME_WINDOW)
from barpanel.functions import scalars as P
from barpanel.operators.ewm import alpha_from, ewm_columns
from barpanel.plans.layout import SeriesLayout


def lag(layout: SeriesLayout, c, k: int = 1) -> Column:
    return F.lag(P.col(c), k).over(layout.window())


def lead(layout: SeriesLayout, c, k: int = 1) -> Column:
    return F.lead(P.col(c), k).over(layout.window())


def rolling_mean(layout: SeriesLayout, c, n: int) -> Column:
    """Mean of the last n rows; NULL until n non-null values are in the frame."""
    f = layout.rows(-(n - 1), 0)
    x = P.col(c)
    return F.when(F.count(x).over(f) == n, F.avg(x).over(f))


def rolling_std(layout: SeriesLayout, c, n: int) -> Column:
    """Sample standard deviation of the last n rows, gated like ``rolling_mean``."""
    f = layout.rows(-(n - 1), 0)
    x = P.col(c)
    return F.when(F.count(x).over(f) == n, F.stddev_samp(x).over(f))


def log_return(df: DataFrame, layout: SeriesLayout, price: str = "close",
               out: str = "log_return") -> DataFrame:
    """ln(p_t / p_{t-1})."""
    return df.withColumn(out, P.safe_ln_ratio(price, lag(layout, price)))


def sma(df: DataFrame, layout: SeriesLayout, c: str = "close", windows=(10, 20, 50),
        ratio: bool = True) -> DataFrame:
    """W2 (+P3): ``sma_n`` and ``sma_n_ratio`` = c / sma_n."""
    cols = {f"sma_{n}": rolling_mean(layout, c, n) for n in windows}
    df = df.withColumns(cols)
    if ratio:
        df = df.withColumns({f"sma_{n}_ratio": P.ratio(c, f"sma_{n}") for n in windows})
    return df


def ewm(df: DataFrame, layout: SeriesLayout, c: str, out: str, com=None, span=None,
        alpha=None) -> DataFrame:
    """One EWM column (use ``ewm_columns`` to batch several)."""
    return ewm_columns(df, layout, {out: (c, alpha_from(com, span, alpha))})


#: What the recurrences carry from bar to bar.
STATES = ("avg_gain", "avg_loss", "ema_12", "ema_26", "macd_signal")


def rsi_macd(df: DataFrame, layout: SeriesLayout, price: str = "close",
             keep_ema: bool = False, resume: str | None = None) -> DataFrame:
    """W4/W5/W6 with P2: RSI(14) and MACD(12, 26, 9) in two EWM passes.

    RSI = 100 - 100/(1 + avg_gain/avg_loss); avg_loss 0 gives NULL.

    ``resume`` names a flag of the rows to go on with. The rows before them are
    only looked back at; the last of them holds the state of each recurrence in
    ``_at_<name>`` (null elsewhere). That state stands as the first observation,
    so the recurrence goes on as if it had never stopped. The states are kept as
    ``_avg_gain``, ``_avg_loss``, ``ema_12`` and ``ema_26``.
    """
    def entered(x, state):
        x = P.col(x)
        return x if resume is None else F.when(F.col(resume), x).otherwise(F.col(f"_at_{state}"))
    delta = P.col(price) - lag(layout, price)
    df = df.withColumn("_delta", delta)
    df = df.withColumns({"_gain": entered(P.clip_gain("_delta"), "avg_gain"),
                         "_loss": entered(P.clip_loss("_delta"), "avg_loss")})
    one = () if resume else ("_delta",)  # inputs with the same gaps share a numbering
    df = ewm_columns(df, layout, {
        "_avg_gain": ("_gain", alpha_from(com=RSI_COM), *one),
        "_avg_loss": ("_loss", alpha_from(com=RSI_COM), *one),
        "ema_12": (entered(price, "ema_12"), alpha_from(span=MACD_FAST_SPAN), *([price] if one else [])),
        "ema_26": (entered(price, "ema_26"), alpha_from(span=MACD_SLOW_SPAN), *([price] if one else [])),
    })
    rs = F.try_divide(F.col("_avg_gain"), F.nullif(F.col("_avg_loss"), F.lit(0.0)))
    df = df.withColumns({
        "rsi_14": F.lit(100.0) - F.try_divide(F.lit(100.0), F.lit(1.0) + rs),
        "macd": F.col("ema_12") - F.col("ema_26"),
    })
    df = ewm_columns(df, layout, {"macd_signal": (entered("macd", "macd_signal"),
                                                  alpha_from(span=MACD_SIGNAL_SPAN))})
    df = df.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    drop = ["_delta", "_gain", "_loss"]
    if resume is None:
        drop += ["_avg_gain", "_avg_loss"]
        if not keep_ema:
            drop += ["ema_12", "ema_26"]
    return df.drop(*drop)


def volatility(df: DataFrame, layout: SeriesLayout, ret: str = "log_return",
               n: int = VOL_WINDOW, out: str = "volatility_20") -> DataFrame:
    """Sample std of n returns × sqrt(252)."""
    return df.withColumn(out, rolling_std(layout, ret, n) * F.lit(math.sqrt(TRADING_DAYS)))


def volume_norm(df: DataFrame, layout: SeriesLayout, vol: str = "volume",
                n: int = VOLUME_WINDOW, out: str = "volume_norm") -> DataFrame:
    """Volume / n-row mean volume; a zero mean gives NULL."""
    m = F.nullif(rolling_mean(layout, vol, n), F.lit(0.0))
    return df.withColumn(out, F.try_divide(P.col(vol).cast("double"), m))


def target_next_up(df: DataFrame, layout: SeriesLayout, ret: str = "log_return",
                   out: str = "target") -> DataFrame:
    """1 if the next return is > 0, else 0 (the last row gets 0)."""
    nxt = lead(layout, ret)
    return df.withColumn(out, F.coalesce((nxt > 0).cast("int"), F.lit(0)))


def causal_dilated_filter(df: DataFrame, layout: SeriesLayout, c: str, weights,
                          dilation: int, out: str) -> DataFrame:
    """y_t = Σ_k w_k · x_{t-(K-1-k)·d}; missing history counts as 0.

    Only past and present rows contribute (causal); receptive field
    (K-1)·d + 1 rows. Stack calls for several dilations.
    """
    K = len(weights)
    terms = []
    for k, w in enumerate(weights):
        shift = (K - 1 - k) * dilation
        x = P.col(c) if shift == 0 else lag(layout, c, shift)
        terms.append(F.lit(float(w)) * F.coalesce(x.cast("double"), F.lit(0.0)))
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return df.withColumn(out, total)


def receptive_field(kernel: int, dilations) -> int:
    return (kernel - 1) * sum(dilations) + 1


def feature_halo() -> tuple[int, int]:
    """Rows of history (and future) the feature set needs for exact results;
    EWMs need none, their state is carried from block to block."""
    return max(50, VOL_WINDOW + 1, VOLUME_WINDOW), 2   # lead of log_return needs 2 rows ahead
