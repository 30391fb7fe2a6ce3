"""Registered queries over batches of new bars: the state of a panel is advanced,
history is not read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from barpanel.constants import FEATURE_COLS
from barpanel.operators import features as FT
from barpanel.operators.live import LiveStore, live_windows
from barpanel.plans.present import RATIO, spark_round
from barpanel.plans.queries import laid_panel, query
from barpanel.sources import panel_io as IO

#: End of the history, and of the first batch after it.
HISTORY, BATCH = "1997-01-01", "1998-06-01"


@query("append_features")
def q_append_features(spark, sf_dir):
    """F1 for appended bars: history, then two batches; the rows of the batches,
    the last of the first one with the target that the second one settles."""
    panel, lay = laid_panel(spark, sf_dir)
    store = LiveStore(spark, IO.scratch_path(spark, "live"))
    store.merge(panel.filter(F.col("date") < HISTORY), lay)
    _, a = store.merge(panel.filter((F.col("date") >= HISTORY) & (F.col("date") < BATCH)))
    _, b = store.merge(panel.filter(F.col("date") >= BATCH))
    settled = b.filter("revised").select("ticker", "date")
    rows = (a.join(settled, ["ticker", "date"], "left_anti").unionByName(b)
            .filter(F.col("date") >= HISTORY))
    rows = rows.withColumn("volume", F.col("volume").cast("bigint"))  # as in the panel
    return spark_round(FT.complete(rows).select("ticker", "date", *FEATURE_COLS, "target"))


@query("append_windows")
def q_append_windows(spark, sf_dir):
    """W10 for appended bars, scaled with the params stored for the history."""
    panel, lay = laid_panel(spark, sf_dir)
    past = panel.filter(F.col("date") < HISTORY)
    path = IO.scratch_path(spark, "scaler")
    FT.save_scaler(FT.fit_minmax(FT.chrono_split(FT.feature_frame(past, lay), lay)), path)
    store = LiveStore(spark, IO.scratch_path(spark, "live"))
    store.merge(past, lay)
    before, rows = store.merge(panel.filter(F.col("date") >= HISTORY))
    w = live_windows(before, rows, FT.load_scaler(spark, path)).filter(~F.col("revised"))
    close = F.transform("seq", lambda x: F.element_at(x, 4).cast("double"))
    return spark_round(w.select("ticker", "date", "y", F.element_at(close, -1).alias("last_close"),
                                F.element_at(close, 1).alias("first_close"),
                                F.size("seq").alias("n")),
                       {"last_close": RATIO, "first_close": RATIO})
