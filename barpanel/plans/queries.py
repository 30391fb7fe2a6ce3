"""Registered queries: one per operator of the inventory, each reading the
given tables (through the panels derived from them) at ``sf_dir``.

Every callable has the signature ``(spark, sf_dir) -> DataFrame``; column
names and rounding match the DuckDB oracle in ``plans.oracles``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barpanel.constants import FEATURE_COLS, OHLCV
from barpanel.functions import scalars as P
from barpanel.operators import features as FT
from barpanel.operators import windows as Wn
from barpanel.operators.ewm import alpha_from, ewm_columns
from barpanel.plans.layout import (PLAIN, AutoLayout, SeriesLayout, blocked, materialize,
                                   resolve)
from barpanel.plans.present import RATIO, spark_round
from barpanel.sources.fixtures import panel_daily, requested_tickers


def default_layout():
    """``auto`` (default): plain windows while every series fits one block of
    BARPANEL_BLOCK_ROWS rows, the blocked skew-safe layout beyond;
    BARPANEL_LAYOUT=plain / blocked forces one."""
    mode = os.environ.get("BARPANEL_LAYOUT", "auto")
    rows = int(os.environ.get("BARPANEL_BLOCK_ROWS", str(1 << 20)))
    if mode == "plain":
        return PLAIN
    if mode == "blocked":
        return blocked(rows)
    return AutoLayout(block_rows=rows)


def layout_for(df, order=None) -> SeriesLayout:
    return resolve(default_layout(), df, order)


def laid_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesLayout]:
    """The daily panel and its layout. The bars are written once, so that the
    size check of the layout does not read the source a second time."""
    panel = materialize(panel_daily(spark, sf_dir))
    return panel, layout_for(panel)


REGISTRY: dict = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _prepared(spark: SparkSession, sf_dir: str, layout: SeriesLayout | None = None) -> dict:
    panel, lay = laid_panel(spark, sf_dir)
    return FT.prepare_panel(panel, layout or lay)


# ---------------------------------------------------------------------------
# W / P: single window operators on the daily panel
# ---------------------------------------------------------------------------
def _windowed(spark, sf_dir, build, cols, layout=None) -> DataFrame:
    panel, lay = laid_panel(spark, sf_dir)
    lay = layout or lay
    lay = lay.with_halo(*Wn.feature_halo())
    df = lay.prepare(panel.select("ticker", "date", *OHLCV))
    df = build(df, lay)
    df = lay.finish(df, keep_ordinal=False)
    return spark_round(df.select("ticker", "date", *cols))


@query("lag_lead")
def q_lag_lead(spark, sf_dir):
    """Previous and next close."""
    def b(df, lay):
        return df.withColumns({"prev_close": Wn.lag(lay, "close"),
                               "next_close": Wn.lead(lay, "close")})
    return _windowed(spark, sf_dir, b, ["close", "prev_close", "next_close"])


@query("log_return")
def q_log_return(spark, sf_dir):
    """P1."""
    return _windowed(spark, sf_dir, lambda df, lay: Wn.log_return(df, lay), ["log_return"])


@query("gain_loss")
def q_gain_loss(spark, sf_dir):
    """Delta, gain, loss (first row NULL)."""
    def b(df, lay):
        df = df.withColumn("delta", F.col("close") - Wn.lag(lay, "close"))
        return df.withColumns({"gain": P.clip_gain("delta"), "loss": P.clip_loss("delta")})
    return _windowed(spark, sf_dir, b, ["delta", "gain", "loss"])


@query("sma")
def q_sma(spark, sf_dir):
    """W2."""
    return _windowed(spark, sf_dir, lambda df, lay: Wn.sma(df, lay, ratio=False),
                     ["sma_10", "sma_20", "sma_50"])


@query("sma_ratio")
def q_sma_ratio(spark, sf_dir):
    """P3."""
    return _windowed(spark, sf_dir, lambda df, lay: Wn.sma(df, lay).drop("sma_10", "sma_20", "sma_50"),
                     ["sma_10_ratio", "sma_20_ratio", "sma_50_ratio"])


@query("ewm_mean")
def q_ewm_mean(spark, sf_dir):
    """EWM of volume (com 13, span 5, alpha 0.3) -- generic alphas."""
    def b(df, lay):
        return ewm_columns(df, lay, {
            "ewm_com13": ("volume", alpha_from(com=13)),
            "ewm_span5": ("volume", alpha_from(span=5)),
            "ewm_a03": ("volume", alpha_from(alpha=0.3))})
    return _windowed(spark, sf_dir, b, ["ewm_com13", "ewm_span5", "ewm_a03"]).transform(
        lambda d: d.select("ticker", "date", *[F.round(c, RATIO).alias(c)
                                               for c in ("ewm_com13", "ewm_span5", "ewm_a03")]))


@query("ema_12_26")
def q_ema(spark, sf_dir):
    """W4."""
    def b(df, lay):
        return ewm_columns(df, lay, {"ema_12": ("close", alpha_from(span=12)),
                                     "ema_26": ("close", alpha_from(span=26))})
    return _windowed(spark, sf_dir, b, ["ema_12", "ema_26"])


@query("macd")
def q_macd(spark, sf_dir):
    """W5."""
    return _windowed(spark, sf_dir, lambda df, lay: Wn.rsi_macd(df, lay),
                     ["macd", "macd_signal", "macd_hist"])


@query("rsi_14")
def q_rsi(spark, sf_dir):
    """W6."""
    return _windowed(spark, sf_dir, lambda df, lay: Wn.rsi_macd(df, lay), ["rsi_14"])


@query("volatility_20")
def q_vol(spark, sf_dir):
    """W7."""
    def b(df, lay):
        return Wn.volatility(Wn.log_return(df, lay), lay)
    return _windowed(spark, sf_dir, b, ["volatility_20"])


@query("volume_norm")
def q_volume_norm(spark, sf_dir):
    """W8."""
    return _windowed(spark, sf_dir, lambda df, lay: Wn.volume_norm(df, lay), ["volume_norm"])


@query("target_next_up")
def q_target(spark, sf_dir):
    """W9."""
    def b(df, lay):
        return Wn.target_next_up(Wn.log_return(df, lay), lay)
    return _windowed(spark, sf_dir, b, ["target"])


@query("causal_dilated_filter")
def q_tcn(spark, sf_dir):
    """Two stacked causal filters (kernel 3, dilations 1 then 2) on log-returns."""
    w = [0.25, -0.5, 1.0]

    def b(df, lay):
        df = Wn.log_return(df, lay)
        df = Wn.causal_dilated_filter(df, lay, "log_return", w, 1, "tcn_d1")
        return Wn.causal_dilated_filter(df, lay, "tcn_d1", w, 2, "tcn_d2")
    return _windowed(spark, sf_dir, b, ["tcn_d1", "tcn_d2"]).select(
        "ticker", "date", F.round("tcn_d1", RATIO).alias("tcn_d1"),
        F.round("tcn_d2", RATIO).alias("tcn_d2"))


# ---------------------------------------------------------------------------
# F: composite jobs
# ---------------------------------------------------------------------------
@query("feature_frame")
def q_feature_frame(spark, sf_dir):
    """F1."""
    p, lay = laid_panel(spark, sf_dir)
    f = FT.feature_frame(p, lay)
    return spark_round(f.select("ticker", "date", *FEATURE_COLS, "target"))


@query("warmup_report")
def q_warmup(spark, sf_dir):
    """F2."""
    return FT.warmup_report(*laid_panel(spark, sf_dir))


@query("chrono_split")
def q_split(spark, sf_dir):
    """split label and position of every complete row."""
    p, lay = laid_panel(spark, sf_dir)
    s = FT.chrono_split(FT.feature_frame(p, lay), lay, keep_pos=True)
    return spark_round(s.select("ticker", "date", "split", F.col("_pos").alias("pos"),
                                F.col("_n").alias("n")))


@query("leakage_check")
def q_leak(spark, sf_dir):
    """F4."""
    p, lay = laid_panel(spark, sf_dir)
    s = FT.chrono_split(FT.feature_frame(p, lay), lay)
    return spark_round(FT.leakage_check(s, requested=requested_tickers(spark, sf_dir)))


@query("split_report")
def q_split_report(spark, sf_dir):
    """F5."""
    p, lay = laid_panel(spark, sf_dir)
    s = FT.chrono_split(FT.feature_frame(p, lay), lay)
    return spark_round(FT.split_bounds(s, requested=requested_tickers(spark, sf_dir)))


@query("fit_minmax")
def q_fit(spark, sf_dir):
    """F6 (long form)."""
    st = _prepared(spark, sf_dir)
    return spark_round(FT.params_long(st["params"]), default=RATIO)


@query("normalize_splits")
def q_norm(spark, sf_dir):
    """every scaled row."""
    st = _prepared(spark, sf_dir)
    return spark_round(st["scaled"].select("ticker", "date", "split", *FEATURE_COLS, "target"),
                       digits={c: RATIO for c in FEATURE_COLS})


@query("minmax_transform")
def q_minmax(spark, sf_dir):
    """Scaled values summarised per ticker × split (out-of-range rows kept)."""
    st = _prepared(spark, sf_dir)
    sc = st["scaled"]
    aggs = []
    for c in ("close", "rsi_14", "volume"):
        aggs += [F.round(F.min(c), RATIO).alias(f"min_{c}"), F.round(F.max(c), RATIO).alias(f"max_{c}")]
    below = sum((F.col(c) < 0).cast("int") for c in FEATURE_COLS)
    above = sum((F.col(c) > 1).cast("int") for c in FEATURE_COLS)
    return sc.groupBy("ticker", "split").agg(
        *aggs, F.sum(below).cast("bigint").alias("n_below_0"),
        F.sum(above).cast("bigint").alias("n_above_1"))


@query("sliding_sequences")
def q_seq(spark, sf_dir):
    """Every window, projected to scalars (size, first, last, sum)."""
    sq = _prepared(spark, sf_dir)["sequences"]
    flat = F.flatten("seq")
    return sq.select(
        "ticker", "split", F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.size("seq").cast("int").alias("n_steps"),
        F.round(F.element_at(F.element_at("seq", 1), 4).cast("double"), RATIO).alias("first_close"),
        F.round(F.element_at(F.element_at("seq", -1), 4).cast("double"), RATIO).alias("last_close"),
        F.round(F.aggregate(flat, F.lit(0.0), lambda a, x: a + x.cast("double")), 3).alias("seq_sum"),
        "y")


@query("sequence_report")
def q_seq_report(spark, sf_dir):
    """F9."""
    return FT.sequence_report(_prepared(spark, sf_dir)["sequences"],
                              requested=requested_tickers(spark, sf_dir))


@query("prepare_panel")
def q_prepare(spark, sf_dir):
    """F10 (flagship): raw orders -> panel -> features -> split -> scaled ->
    sequences; the outcome of every requested ticker × split."""
    return spark_round(FT.prepare_report(_prepared(spark, sf_dir),
                                         requested_tickers(spark, sf_dir)))


@query("scaler_store")
def q_scaler_store(spark, sf_dir):
    """F8: scaler params written to Parquet, read back and re-applied to the
    split frame (inference path): equals the fitted scaling."""
    from barpanel.sources.panel_io import scratch_path
    st = _prepared(spark, sf_dir)
    path = scratch_path(spark, "scaler")
    FT.save_scaler(st["params"], path)
    again = FT.apply_minmax(st["split"], FT.load_scaler(spark, path))
    return spark_round(again.select("ticker", "date", "split", *FEATURE_COLS, "target"),
                       digits={c: RATIO for c in FEATURE_COLS})
