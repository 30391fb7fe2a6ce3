"""How an ordered panel is laid out for window work.

A window ``partitionBy(ticker).orderBy(date)`` puts one ticker's whole history
into one task. That is fine for many modest series, but a single hot ticker
(say a third of all rows) would then be sorted and scanned by one task. The
*blocked* layout removes that limit:

1. ``with_ordinal`` numbers the rows of every series (``_rn``, 0-based) without
   a per-ticker window: the panel is range-partitioned on (ticker, order), so a
   hot ticker spans many tasks; each row's ordinal is its position inside its
   range partition plus the row count of the same ticker in earlier
   partitions (a summary of at most partitions + tickers rows).
2. Rows are cut into blocks of ``block_rows`` consecutive ordinals. A block
   also receives a *halo*: copies of the ``halo_back`` rows before it (and
   ``halo_ahead`` rows after it, for ``lead``). Window partitions are then
   (ticker, _blk), bounded by ``block_rows + halo`` rows, and every frame that
   looks at most ``halo`` rows back gives exactly the per-ticker result on the
   block's own rows (``_own``).

The plain layout keeps ``partitionBy(ticker)`` for data sets whose largest
series comfortably fits one task; both layouts run the same operator code.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barpanel.session import shuffle_partitions

def with_ordinal(df: DataFrame, key: str, order: list[str], out: str = "_rn",
                 partitions: int | None = None) -> DataFrame:
    """Add a 0-based ordinal of each row within its ``key``, by ``order``. The
    summary is joined without a hint: sizes in bytes decide.

    ``order`` must be unique within a key (it is the series' time axis plus a
    tie-breaker). Skew-safe: no window or group holds a whole key.
    """
    spark = df.sparkSession
    n = partitions or shuffle_partitions(spark)
    # The ids depend on the range bounds, so they are stamped once and
    # checkpointed: the summary and the join below read the same rows, and a
    # lost executor re-reads the checkpoint instead of re-sampling bounds.
    r = materialize(df.repartitionByRange(n, key, *order)
                    .sortWithinPartitions(key, *order)
                    .withColumn("_mid", F.monotonically_increasing_id())
                    .withColumn("_pid", F.shiftright("_mid", 33)))
    summ = r.groupBy(key, "_pid").agg(F.min("_mid").alias("_m0"),
                                      F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    summ = summ.select(key, "_pid", "_m0",
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (r.join(summ, [key, "_pid"])
            .select(*df.columns, (F.col("_mid") - F.col("_m0") + F.col("_off")).alias(out)))


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage at a stage boundary: a reliable checkpoint written to
    the shared folder named by ``spark.checkpoint.dir`` (survives lost
    executors; later size checks read it instead of recomputing)."""
    from barpanel.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@dataclass(frozen=True)
class SeriesLayout:
    key: str = "ticker"
    order: tuple = ("date",)
    block_rows: int | None = None   # None: plain layout
    halo_back: int = 0
    halo_ahead: int = 0
    ranges: int | None = None       # range partitions for numbering; None: the session's

    # -- construction ---------------------------------------------------------
    @property
    def blocked(self) -> bool:
        return self.block_rows is not None

    def with_halo(self, back: int, ahead: int = 0) -> "SeriesLayout":
        return replace(self, halo_back=back, halo_ahead=ahead)

    # -- window specs ---------------------------------------------------------
    def partition_cols(self) -> list[str]:
        return [self.key, "_blk"] if self.blocked else [self.key]

    def order_cols(self) -> list[str]:
        return ["_rn"] if self.blocked else list(self.order)

    def window(self) -> Window:
        return Window.partitionBy(*self.partition_cols()).orderBy(*self.order_cols())

    def rows(self, lo, hi) -> Window:
        return self.window().rowsBetween(lo, hi)

    def sub_window(self, *extra: str) -> Window:
        """Window over a finer partition (e.g. EWM sub-blocks)."""
        return Window.partitionBy(*self.partition_cols(), *extra).orderBy(*self.order_cols())

    # -- preparing and finishing a frame --------------------------------------
    def prepare(self, df: DataFrame, ordinal: str | None = None) -> DataFrame:
        """Lay ``df`` out for window work.

        Blocked: number rows (or reuse column ``ordinal``), explode halo copies.
        Plain: unchanged.
        """
        if not self.blocked:
            return df
        if ordinal is None:
            df = with_ordinal(df, self.key, list(self.order), "_rn", self.ranges)
        elif ordinal != "_rn":
            df = df.withColumn("_rn", F.col(ordinal))
        b = self.block_rows
        # a halo longer than a block makes a row a halo row of several blocks
        rn = F.col("_rn")
        lo = F.greatest(rn - F.lit(self.halo_ahead), F.lit(0)) / F.lit(b)
        hi = (rn + F.lit(self.halo_back)) / F.lit(b)
        own = F.floor(rn / F.lit(b))
        cols = [c for c in df.columns if c not in ("_blk", "_own")]
        return (df.select(*cols,
                          F.explode(F.sequence(F.floor(lo), F.floor(hi))).alias("_blk"),
                          own.alias("_own_blk"))
                .withColumn("_own", F.col("_blk") == F.col("_own_blk"))
                .drop("_own_blk"))

    def finish(self, df: DataFrame, keep_ordinal: bool = True) -> DataFrame:
        """Keep each row once (its own block); drop helper columns."""
        if not self.blocked:
            return df
        df = df.filter(F.col("_own")).drop("_own")
        return df if keep_ordinal else df.drop("_rn", "_blk")

    # -- positions among the rows of a (possibly filtered) frame --------------
    def positions(self, df: DataFrame, pos: str = "_pos", count: str = "_n") -> DataFrame:
        """Add the 0-based position of each row in its series and the series
        length, over the rows present in ``df`` (e.g. after a ``dropna``).

        Blocked: a running count inside each (ticker, _blk) partition plus the
        row count of earlier blocks, from a per-block summary -- no window
        spans a whole ticker.
        """
        if not self.blocked:
            w = Window.partitionBy(self.key)
            return df.withColumns({
                pos: F.row_number().over(self.window()) - 1,
                count: F.count(F.lit(1)).over(w)})
        local = df.withColumn("_loc", F.row_number().over(self.window()) - 1)
        per_blk = local.groupBy(self.key, "_blk").agg(F.count(F.lit(1)).alias("_bn"))
        before = Window.partitionBy(self.key).orderBy("_blk").rowsBetween(
            Window.unboundedPreceding, -1)
        whole = Window.partitionBy(self.key)
        per_blk = per_blk.select(
            self.key, "_blk",
            F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_boff"),
            F.sum("_bn").over(whole).alias(count))
        return (local.join(per_blk, [self.key, "_blk"])
                .withColumn(pos, F.col("_loc") + F.col("_boff"))
                .drop("_loc", "_boff"))


PLAIN = SeriesLayout()


@dataclass(frozen=True)
class AutoLayout:
    """Decide per data set: plain windows while the largest series fits one
    block, the blocked (skew-safe) layout beyond. The check is a grouped
    count per key (map-side partial aggregation, one small exchange)."""
    key: str = "ticker"
    order: tuple = ("date",)
    block_rows: int = 1 << 20

    def resolve(self, df: DataFrame) -> SeriesLayout:
        rows, biggest = (df.groupBy(self.key).count()
                         .agg(F.sum("count"), F.max("count")).first())
        if (biggest or 0) <= self.block_rows:
            return SeriesLayout(key=self.key, order=self.order)
        # a range partition holds about one block, whatever the panel's size
        ranges = max(shuffle_partitions(df.sparkSession), -(-rows // self.block_rows))
        return SeriesLayout(key=self.key, order=self.order, block_rows=self.block_rows,
                            ranges=ranges)


def resolve(layout, df: DataFrame, order=None) -> SeriesLayout:
    """A concrete layout for ``df`` (``order`` overrides the time axis)."""
    if order is not None:
        layout = replace(layout, order=tuple(order))
    if isinstance(layout, AutoLayout):
        return layout.resolve(df)
    return layout


def blocked(block_rows: int = 1 << 20, key: str = "ticker", order=("date",)) -> SeriesLayout:
    return SeriesLayout(key=key, order=tuple(order), block_rows=block_rows)
