"""The whole preparation as one job that stores what training and inference need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpanel.constants import DEFAULT_WINDOW
from barpanel.operators import features as FT
from barpanel.plans.layout import PLAIN, SeriesLayout, materialize
from barpanel.sources import panel_io as IO


def prepare_to_store(panel: DataFrame, root: str, layout: SeriesLayout = PLAIN,
                     window: int = DEFAULT_WINDOW, requested: DataFrame | None = None) -> DataFrame:
    """F10 with S9, F8 and S10: bars to the scaled splits (``root``/processed), the
    scaler's params (``root``/scaler) and the windows, in blocks of rows
    (``root``/windows). Tickers whose splits overlap or are empty (F4) are stored
    nowhere and are FAIL in the report that is returned: a row per requested ticker
    (all of the panel's without ``requested``) with its rows per split. Only
    the tickers of ``panel`` are replaced in the stores."""
    key, order = layout.key, layout.order[0]
    st = FT.prepare_panel(panel, layout, window)
    requested = panel.select(key).distinct() if requested is None else requested
    gate = materialize(FT.leakage_check(st["split"], key, order, requested))
    good = gate.filter("ok").select(key)
    scaled = st["scaled"].join(good, key, "left_semi")
    helpers = [c for c in ("_rn", "_blk", "_pos", "_n") if c in scaled.columns]
    IO.write_processed(scaled.drop(*helpers), f"{root}/processed", key)
    FT.save_scaler(st["params"].join(good, key, "left_semi"), f"{root}/scaler", key)
    IO.write_window_blocks(FT.window_blocks(scaled, window, key=key, order=order),
                           f"{root}/windows", key)
    s = F.col("split")
    rows = st["split"].groupBy(key).agg(*[
        F.count(F.when(s == x, 1)).alias(f"n_{x}") for x in FT.SPLITS])
    return gate.select(key, F.when(F.col("ok"), "OK").otherwise("FAIL").alias("status")).join(
        rows, key, "left").select(key, "status", *[
            F.coalesce(f"n_{x}", F.lit(0)).alias(f"n_{x}") for x in FT.SPLITS])
