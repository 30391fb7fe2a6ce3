"""Features and windows of new bars, without reading history.

The *state* of a panel is a small table with one row per ticker: the last
``TAIL`` bars (what bounded windows look back at), the value of every recurrence
(EWMs of gains, losses, prices and the MACD line), and the features of the last
complete rows (the open window). New bars are appended to their tickers' tails,
the same operators run over those few rows, and the state's values stand in for
everything before. The result equals a full recomputation, in time that grows
with the new bars and the tickers they belong to.

``advance`` from an empty state over a whole panel is that full computation, and
gives the first state. States live in a ``PanelStore``, so merging a batch
replaces the tickers it holds and no others; a batch whose state was not
published is simply given again.

A new bar also settles the bar before it, whose target was not known: that row
comes back, marked ``revised``. Bars that are not after a ticker's last date are
left out (they have been counted, or need a recomputation); of two new bars of
one ticker and date, the caller keeps one (``quality.dedup_first``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barpanel.constants import DEFAULT_WINDOW, FEATURE_COLS, OHLCV
from barpanel.operators import features as FT
from barpanel.operators import windows as Wn
from barpanel.plans.layout import PLAIN, SeriesLayout, materialize
from barpanel.sources.store import PanelStore

#: Bars that the widest window needs, the last one included.
TAIL = 50
BAR = "struct<date:date,open:double,high:double,low:double,close:double,volume:double>"
STATE = ("ticker string, last_date date, tail array<" + BAR + ">, "
         + ", ".join(f"{s} double" for s in Wn.STATES)
         + ", open_window array<struct<date:date,x:array<double>>>")


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def _rows(state: DataFrame, bars: DataFrame) -> DataFrame:
    """The tails of the tickers that have new bars, and the new bars: ``_new``
    marks the latter, ``_seed`` the last known bar, which holds the states."""
    cols = [F.col(c).cast("double").alias(c) for c in OHLCV]
    new = (bars.select("ticker", F.col("date").cast("date").alias("date"), *cols)
           .join(state.select("ticker", "last_date"), "ticker", "left")
           .filter(F.col("last_date").isNull() | (F.col("date") > F.col("last_date")))
           .drop("last_date"))
    tails = (state.join(new.select("ticker").distinct(), "ticker", "left_semi")
             .withColumn("bar", F.explode("tail"))
             .select("ticker", "bar.*", (F.col("bar.date") == F.col("last_date")).alias("_seed"),
                     *[F.when(F.col("bar.date") == F.col("last_date"), F.col(s)).alias(f"_at_{s}")
                       for s in Wn.STATES]))
    none = F.lit(None).cast("double")
    return (tails.withColumn("_new", F.lit(False)).unionByName(
        new.withColumns({"_seed": F.lit(False), "_new": F.lit(True),
                         **{f"_at_{s}": none for s in Wn.STATES}})))


def _last(df: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of each ticker; tasks keep no more before the exchange."""
    w = Window.partitionBy("ticker").orderBy(F.desc("date"))
    return df.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= n).drop("_k")


def advance(state: DataFrame, bars: DataFrame, layout: SeriesLayout = PLAIN,
            window: int = DEFAULT_WINDOW) -> tuple[DataFrame, DataFrame]:
    """(features, next state). Features: a row per new bar, and per ticker the
    last known bar again with its target now known (``revised``). The next state
    has the tickers of the batch only. The rows in between are written once."""
    lay = layout.with_halo(*Wn.feature_halo())
    df = lay.prepare(_rows(state, bars))
    df = Wn.log_return(df, lay)
    df = Wn.sma(df, lay)
    df = Wn.rsi_macd(df, lay, resume="_new")
    df = Wn.volatility(df, lay)
    df = Wn.volume_norm(df, lay)
    df = Wn.target_next_up(df, lay)
    df = materialize(lay.finish(df, keep_ordinal=False))
    fresh = df.filter(F.col("_new") | F.col("_seed"))
    features = fresh.select("ticker", "date", *FEATURE_COLS, "target",
                            F.col("_seed").alias("revised"))

    tail = (_last(df, TAIL).groupBy("ticker").agg(
        F.max("date").alias("last_date"),
        F.sort_array(F.collect_list(F.struct("date", *OHLCV))).alias("tail")))
    values = {"avg_gain": "_avg_gain", "avg_loss": "_avg_loss"}
    ends = fresh.groupBy("ticker").agg(*[
        F.max_by(values.get(s, s), "date").alias(s) for s in Wn.STATES])
    known = state.join(df.select("ticker").distinct(), "ticker", "left_semi").select(
        "ticker", F.explode("open_window").alias("w")).select("ticker", "w.date", "w.x")
    complete = FT.complete(features.filter(~F.col("revised"))).select(
        "ticker", "date", F.array(*[F.col(c).cast("double") for c in FEATURE_COLS]).alias("x"))
    # the window before the last row, and that row
    open_ = (_last(known.unionByName(complete), window + 1).groupBy("ticker")
             .agg(F.sort_array(F.collect_list(F.struct("date", "x"))).alias("open_window")))
    after = (tail.join(ends, "ticker").join(open_, "ticker", "left")
             .withColumn("open_window", F.coalesce("open_window", F.expr(
                 "cast(array() as array<struct<date:date,x:array<double>>>)"))))
    return features, after.select("ticker", "last_date", "tail", *Wn.STATES, "open_window")


def live_windows(state: DataFrame, features: DataFrame, scaler: DataFrame,
                 window: int = DEFAULT_WINDOW) -> DataFrame:
    """W10 for the rows of ``features`` (of :func:`advance` from ``state``): the
    ``window`` complete rows before each, scaled with the stored params, and
    the target: (ticker, date, seq, y, revised)."""
    rows = FT.complete(features).withColumn("x", F.array(*[F.col(c).cast("double")
                                                          for c in FEATURE_COLS]))
    # a revised row is the last of the open window already
    old = (state.join(rows.select("ticker").distinct(), "ticker", "left_semi")
           .select("ticker", F.explode("open_window").alias("w")).select("ticker", "w.date", "w.x")
           .join(rows.select("ticker", "date"), ["ticker", "date"], "left_anti")
           .withColumns({"y": F.lit(None).cast("bigint"), "revised": F.lit(None).cast("boolean")}))
    u = old.unionByName(rows.select("ticker", "date", "x", F.col("target").cast("bigint").alias("y"),
                                    "revised"))
    lo = F.array(*[F.col(f"min_{c}") for c in FEATURE_COLS])
    hi = F.array(*[F.col(f"max_{c}") for c in FEATURE_COLS])
    j = u.join(scaler.select("ticker", F.arrays_zip(lo.alias("lo"), hi.alias("hi")).alias("_m")),
               "ticker")
    scaled = F.zip_with("x", "_m", lambda v, m: ((v - m["lo"]) / F.when(
        m["hi"] == m["lo"], 1.0).otherwise(m["hi"] - m["lo"])).cast("float"))
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(-window, -1)
    return (j.withColumn("seq", F.collect_list(scaled).over(w))
            .filter(F.col("revised").isNotNull() & (F.size("seq") == window))
            .select("ticker", "date", "seq", "y", "revised"))


class LiveStore:
    """The state of a panel on disk, advanced batch by batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.store = spark, PanelStore(spark, path)

    def state(self) -> DataFrame:
        df = self.store.read()
        return empty_state(self.spark) if df is None else df

    def merge(self, bars: DataFrame, layout: SeriesLayout = PLAIN,
              window: int = DEFAULT_WINDOW) -> tuple[DataFrame, DataFrame]:
        """Advances the state by a batch; (state before, features). Whoever
        stores the features does so before the next batch is merged."""
        before = self.state()
        features, after = advance(before, bars, layout, window)
        self.store.write(after)
        return before, features
