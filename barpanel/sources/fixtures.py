"""Price panels derived from the given tables.

All three are one grouped aggregate over a base table, so their work grows
with the table: partial (map-side) aggregation first, then one exchange on the
(ticker, bar) key. Open / close are the prices of the smallest / largest key
in the bar (``min_by`` / ``max_by``), a deterministic tie rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bars(df: DataFrame, ticker, bar, price: str, key: str) -> DataFrame:
    return (df.groupBy(ticker.alias("ticker"), bar.alias("date"))
            .agg(F.min_by(price, key).alias("open"),
                 F.max(price).alias("high"),
                 F.min(price).alias("low"),
                 F.max_by(price, key).alias("close"),
                 F.count(F.lit(1)).cast("bigint").alias("volume")))


def panel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: daily bars of ``orders`` per ``o_orderpriority``."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    return _bars(o, F.col("o_orderpriority"), F.to_date("o_orderdate"),
                 "o_totalprice", "o_orderkey")


def panel_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: hourly bars of ``events.value`` per ``event_type`` (TIMESTAMP date)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return _bars(e, F.col("event_type"), F.date_trunc("hour", "ts"), "value", "event_id")


def requested_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a collection asks for: every ticker of the panel and one that has
    no data."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("ticker")).distinct()
    return o.unionByName(o.agg(F.lit("9.ABSENT").alias("ticker")))


def panel_dirty(spark: SparkSession, sf_dir: str, missing: str = "null") -> DataFrame:
    """The daily panel with injected defects, in ingest order ``seq``.

    Columns: ticker, date, open, high, low, close, volume (DOUBLE), rev, seq.
    Missing prices are NULL or, with ``missing="nan"``, NaN as a file of floats
    would hold them; every reader passes ``panel_io.nan_to_null``. A real ingest
    log carries ``seq``; here it numbers (date, rev) per ticker by the range
    partitions of ``with_ordinal``, so no ticker is held by one task.
    """
    from barpanel.plans.layout import with_ordinal
    p = panel_daily(spark, sf_dir).withColumn("volume", F.col("volume").cast("double"))
    d = F.dayofmonth("date")
    m = F.month("date")
    gap = F.lit(None if missing == "null" else float("nan")).cast("double")
    all_null = d == 29
    open_null = (d == 3) & (m % 2 == 1)
    # the first days of every series lack a low: a leading gap
    low_null = F.col("date") < F.lit("1995-01-15").cast("date")
    close_null = ((d == 17) & (m % 2 == 0)) | (
        (F.col("ticker") == "5-LOW") & d.isin(11, 22))
    vol_null = d == 13
    base = p.select(
        "ticker", "date",
        F.when(all_null | open_null, gap).otherwise(F.col("open")).alias("open"),
        F.when(all_null, gap).otherwise(F.col("high")).alias("high"),
        F.when(all_null | low_null, gap).otherwise(F.col("low")).alias("low"),
        F.when(all_null | close_null, gap).otherwise(F.col("close")).alias("close"),
        F.when(vol_null, gap).otherwise(F.col("volume")).alias("volume"),
        F.lit(1).alias("rev"))
    dup = (base.filter(F.dayofmonth("date") == 7)
           .select("ticker", "date",
                   *[(F.col(c) + 1).alias(c) for c in ("open", "high", "low", "close")],
                   "volume", F.lit(2).alias("rev")))
    n = with_ordinal(base.unionByName(dup), "ticker", ["date", "rev"], "_n")
    return n.withColumn("seq", (F.col("_n") + 1).cast("bigint")).drop("_n")
