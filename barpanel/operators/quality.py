"""Quality gate and cleaning (Q1-Q8).

Order of the reference's ``clean``: drop rows whose four prices are all
null -> forward fill -> backward fill (leading gap) -> volume null -> 0 ->
keep the first row per date in ingest order -> sort by date. The fills run in
*ingest order* (``seq``), before the de-duplication.

A fill looks back (or ahead) without bound, so it cannot use a halo. Under the
blocked layout it is a two-level scan instead: a fill inside each block, and for
what is left the nearest value of the earlier (later) blocks, found on a
per-block summary (one row per block). Frames only ever grow, also backward (the
order is reversed), so a fill is linear in the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barpanel.constants import MAX_NULL_RATE, OHLC, OHLCV
from barpanel.plans.layout import PLAIN, SeriesLayout, materialize


# ---------------------------------------------------------------------------
# Q1 / Q2
# ---------------------------------------------------------------------------
def null_rates(raw: DataFrame, key: str = "ticker", cols=OHLCV) -> DataFrame:
    """Q1: share of nulls per key and column, one grouped pass."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.avg(F.col(c).isNull().cast("int")).alias(f"null_{c}") for c in cols]
    return raw.groupBy(key).agg(*aggs)


def validate_gate(raw: DataFrame, key: str = "ticker", cols=OHLCV,
                  max_rate: float = MAX_NULL_RATE, requested: DataFrame | None = None) -> DataFrame:
    """Q2: ``ok`` unless the key has no rows or a column's null rate > max_rate
    (a rate of exactly max_rate passes). With ``requested`` (a table of keys)
    every requested key has a row; one without data has 0 rows and fails."""
    r = null_rates(raw, key, cols)
    if requested is not None:
        r = requested.select(key).distinct().join(r, key, "left").withColumn(
            "n_rows", F.coalesce("n_rows", F.lit(0)))
    worst = F.greatest(*[F.col(f"null_{c}") for c in cols])
    return r.withColumns({"max_null_rate": worst, "ok": F.coalesce(
        (F.col("n_rows") > 0) & (worst <= F.lit(max_rate)), F.lit(False))})


def keep_valid(raw: DataFrame, gate: DataFrame, key: str = "ticker") -> DataFrame:
    """Rows of the tickers that pass the gate (semi join on a one-row-per-ticker
    table)."""
    return raw.join(gate.filter(F.col("ok")).select(key), key, "left_semi")


# ---------------------------------------------------------------------------
# Q3 - Q7
# ---------------------------------------------------------------------------
def drop_all_null_prices(raw: DataFrame, cols=OHLC) -> DataFrame:
    """Q3: drop a row only when every price is null."""
    return raw.dropna(how="all", subset=list(cols))


def _ingest_layout(layout: SeriesLayout, order: str) -> SeriesLayout:
    from dataclasses import replace
    return replace(layout, order=(order,), halo_back=0, halo_ahead=0)


def _fill(df: DataFrame, cols, layout: SeriesLayout, order: str, ahead: bool) -> DataFrame:
    """The nearest known value at or before (``ahead``: at or after) each row."""
    lay = _ingest_layout(layout, order)
    key = lay.key

    def by(c):
        return F.col(c).desc() if ahead else F.col(c).asc()
    upto = (Window.unboundedPreceding, 0)
    if not lay.blocked:
        w = Window.partitionBy(key).orderBy(by(order)).rowsBetween(*upto)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    d = lay.prepare(df)
    w = Window.partitionBy(key, "_blk").orderBy(by("_rn")).rowsBetween(*upto)
    d = materialize(d.withColumns({f"_in_{c}": F.last(c, ignorenulls=True).over(w) for c in cols}))
    # the value nearest to the next block, then to any block after it
    pick = F.min_by if ahead else F.max_by
    summ = d.groupBy(key, "_blk").agg(*[
        pick(c, F.when(F.col(c).isNotNull(), F.col("_rn"))).alias(f"_bl_{c}") for c in cols])
    beyond = Window.partitionBy(key).orderBy(by("_blk")).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(key, "_blk", *[
        F.last(f"_bl_{c}", ignorenulls=True).over(beyond).alias(f"_carry_{c}") for c in cols])
    d = d.join(summ, [key, "_blk"])
    d = d.withColumns({c: F.coalesce(f"_in_{c}", f"_carry_{c}") for c in cols})
    return lay.finish(d, keep_ordinal=False).drop(
        *[f"_{p}_{c}" for c in cols for p in ("in", "carry")])


def forward_fill(df: DataFrame, cols=OHLC, layout: SeriesLayout = PLAIN,
                 order: str = "seq") -> DataFrame:
    """Q4: carry the last known value forward, per column, in ``order``."""
    return _fill(df, cols, layout, order, ahead=False)


def backward_fill(df: DataFrame, cols=OHLC, layout: SeriesLayout = PLAIN,
                  order: str = "seq") -> DataFrame:
    """Q5: carry the next known value backward; after Q4 only a leading gap is
    left to fill."""
    return _fill(df, cols, layout, order, ahead=True)


def fill_volume(df: DataFrame, col: str = "volume") -> DataFrame:
    """Q6: volume null -> 0, truncated to BIGINT."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(0)).cast("bigint"))


def dedup_first(df: DataFrame, key: str = "ticker", date: str = "date",
                order: str = "seq") -> DataFrame:
    """Q7: one row per (key, date): the first in ingest order. The window is
    partitioned by (key, date), so no group is larger than one day's copies."""
    w = Window.partitionBy(key, date).orderBy(order)
    return df.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") == 1).drop("_k")


def clean_panel(raw: DataFrame, layout: SeriesLayout = PLAIN, order: str = "seq") -> DataFrame:
    """Q8: Q3 -> Q4 -> Q5 -> Q6 -> Q7 (the final sort is left to the consumer:
    the feature job orders by date itself)."""
    key = layout.key
    d = drop_all_null_prices(raw)
    d = forward_fill(d, OHLC, layout, order)
    d = backward_fill(d, OHLC, layout, order)
    d = fill_volume(d)
    d = dedup_first(d, key, "date", order)
    return d.select(key, "date", *OHLCV, order)
