"""Sorting and selection (K1-K3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barpanel.constants import IMPROVE_EPS
from barpanel.plans.layout import PLAIN, SeriesLayout


def sort_panel(df: DataFrame, layout: SeriesLayout = PLAIN, out: str = "pos") -> DataFrame:
    """K1: position of every row in date order within its ticker (range
    partitioned under the blocked layout); ``orderBy`` only for final output."""
    if layout.blocked:
        from barpanel.plans.layout import with_ordinal
        return with_ordinal(df, layout.key, list(layout.order), out)
    from pyspark.sql import Window
    w = Window.partitionBy(layout.key).orderBy(*layout.order)
    return df.withColumn(out, F.row_number().over(w) - 1)


def best_trial(results: DataFrame, by=("study",), value: str = "value",
               trial: str = "trial") -> DataFrame:
    """K2: the trial with the highest value per study; ties -> lowest trial.
    ``max_by`` over a (value, -trial) struct: one grouped aggregate."""
    key = F.struct(F.col(value).alias("v"), (-F.col(trial)).alias("t"))
    others = [c for c in results.columns if c not in (*by, value, trial)]
    row = F.struct(*[F.col(c) for c in (trial, value, *others)])
    g = results.groupBy(*by).agg(F.max_by(row, key).alias("_b"), F.count(F.lit(1)).alias("n_trials"))
    return g.select(*by, "_b.*", "n_trials")


def early_stop(curves: DataFrame, patience: int, by=("run",), step: str = "step",
               val: str = "val", eps: float = IMPROVE_EPS) -> DataFrame:
    """K3: replay early stopping over each loss curve.

    Improvement only if val < best - eps; otherwise the counter grows; the run
    stops at the first step where counter >= patience. Returns stop_step
    (last step run), best_step, best_val. One run's curve (its steps, not the
    data) is folded by ``aggregate`` over a struct state -- no UDF.
    """
    pts = F.array_sort(F.collect_list(F.struct(F.col(step).alias("s"), F.col(val).alias("v"))))
    init = F.struct(F.lit(None).cast("double").alias("best"), F.lit(None).cast("long").alias("best_step"),
                    F.lit(0).alias("wait"), F.lit(False).alias("stopped"),
                    F.lit(None).cast("long").alias("stop_step"))

    def fold(acc: Column, e: Column) -> Column:
        improve = acc["best"].isNull() | (e["v"] < acc["best"] - F.lit(eps))
        live = ~acc["stopped"]
        wait = F.when(improve, F.lit(0)).otherwise(acc["wait"] + 1)
        return F.when(live, F.struct(
            F.when(improve, e["v"]).otherwise(acc["best"]).alias("best"),
            F.when(improve, e["s"].cast("long")).otherwise(acc["best_step"]).alias("best_step"),
            wait.alias("wait"),
            (wait >= F.lit(patience)).alias("stopped"),
            e["s"].cast("long").alias("stop_step"))).otherwise(acc)

    g = curves.groupBy(*by).agg(F.aggregate(pts, init, fold).alias("_st"))
    return g.select(*by, F.col("_st.stop_step").alias("stop_step"),
                    F.col("_st.best_step").alias("best_step"),
                    F.col("_st.best").alias("best_val"),
                    F.col("_st.stopped").alias("stopped_early"))
