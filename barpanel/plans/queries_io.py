"""Registered queries for quality / cleaning (Q) and sources / sinks (S)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barpanel.constants import FEATURE_COLS, OHLC, OHLCV
from barpanel.operators import features as FT
from barpanel.operators import quality as QL
from barpanel.plans.present import RATIO, spark_round
from barpanel.operators import windows as Wn
from barpanel.plans.layout import materialize
from barpanel.plans.queries import _prepared, layout_for, query
from barpanel.sources import panel_io as IO
from barpanel.sources.fixtures import (panel_daily, panel_dirty, panel_hourly, requested_tickers,
                                       table)

_DIRTY_DIGITS = {"volume": 4}


def _dirty(spark, sf_dir, missing="null"):
    return IO.nan_to_null(panel_dirty(spark, sf_dir, missing))


# Q ---------------------------------------------------------------------------
@query("null_rate")
def q_null_rate(spark, sf_dir):
    """Q1."""
    return spark_round(QL.null_rates(_dirty(spark, sf_dir)), default=RATIO)


@query("validate_gate")
def q_gate(spark, sf_dir):
    """Q2."""
    g = QL.validate_gate(_dirty(spark, sf_dir), requested=requested_tickers(spark, sf_dir))
    return spark_round(g.select("ticker", "n_rows", "max_null_rate", "ok"), default=RATIO)


@query("drop_all_null_ohlc")
def q_drop_all_null(spark, sf_dir):
    """Q3."""
    d = QL.drop_all_null_prices(_dirty(spark, sf_dir))
    return spark_round(d.select("ticker", "date", "seq", "rev", *OHLCV), _DIRTY_DIGITS)


@query("ffill")
def q_ffill(spark, sf_dir):
    """Q4: after Q3, prices carried forward in ingest order."""
    d = materialize(QL.drop_all_null_prices(_dirty(spark, sf_dir)))
    d = QL.forward_fill(d, OHLC, layout_for(d, ["seq"]))
    return spark_round(d.select("ticker", "seq", "date", *OHLC))


@query("bfill")
def q_bfill(spark, sf_dir):
    """Q5: Q3 -> Q4 -> Q5."""
    d = materialize(QL.drop_all_null_prices(_dirty(spark, sf_dir)))
    lay = layout_for(d, ["seq"])
    d = QL.backward_fill(QL.forward_fill(d, OHLC, lay), OHLC, lay)
    return spark_round(d.select("ticker", "seq", "date", *OHLC))


@query("volume_fill")
def q_volume_fill(spark, sf_dir):
    """Q6."""
    d = QL.fill_volume(QL.drop_all_null_prices(_dirty(spark, sf_dir)))
    return d.select("ticker", "seq", "volume")


@query("dedup_first")
def q_dedup(spark, sf_dir):
    """Q7 on the raw dirty panel."""
    d = QL.dedup_first(_dirty(spark, sf_dir))
    return spark_round(d.select("ticker", "date", "seq", "rev", "close"))


@query("clean_panel")
def q_clean(spark, sf_dir):
    """Q8."""
    raw = materialize(_dirty(spark, sf_dir))
    d = QL.clean_panel(raw, layout_for(raw, ["seq"]))
    return spark_round(d.select("ticker", "date", *OHLCV))


# S ---------------------------------------------------------------------------
@query("scan_panel")
def q_scan(spark, sf_dir):
    """Two tickers, 1996-01-01 <= date < 1999-01-01."""
    d = IO.scan_panel(panel_daily(spark, sf_dir), ["1-URGENT", "3-MEDIUM"],
                      "1996-01-01", "1999-01-01")
    return spark_round(d)


@query("tag_union_panel")
def q_tag_union(spark, sf_dir):
    """S3: daily bars of two sources, each tagged with a constant ticker."""
    o = table(spark, sf_dir, "orders")
    e = table(spark, sf_dir, "events")
    bars_o = o.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"), F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"), F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count(F.lit(1)).alias("volume"))
    bars_e = e.groupBy(F.to_date("ts").alias("date")).agg(
        F.min_by("value", "event_id").alias("open"), F.max("value").alias("high"),
        F.min("value").alias("low"), F.max_by("value", "event_id").alias("close"),
        F.count(F.lit(1)).alias("volume"))
    u = IO.tag_union({"ORDERS": bars_o, "EVENTS": bars_e})
    return spark_round(u.select("ticker", "date", *OHLCV))


@query("utc_naive_date")
def q_utc(spark, sf_dir):
    """Hourly bars with a zone-less bar time and its calendar day."""
    h = panel_hourly(spark, sf_dir)
    utc = IO.utc_naive(h, "date")
    return spark_round(h.select(
        "ticker", F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("bar"),
        F.date_format(F.to_date(utc), "yyyy-MM-dd").alias("day"), "close"))


@query("utc_offset_text")
def q_utc_text(spark, sf_dir):
    """Event times as feeds would write them (offsets, Z, a zone's name, none),
    each back as zone-less UTC. New York's clocks change within the data."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("t"))
    def written(shift, tail, style="yyyy-MM-dd HH:mm:ss.SSSSSS"):
        at = F.col("t") + F.make_dt_interval(mins=F.lit(shift))
        return F.concat(F.date_format(at, style), F.lit(tail))
    ny = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), "t")
    # the hour that New York's clocks repeat cannot be told from its name
    clear = F.convert_timezone(F.lit("America/New_York"), F.lit("UTC"), ny) == F.col("t")
    k = F.col("event_id") % 6
    text = (F.when(k == 0, written(0, "Z", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .when(k == 1, written(330, "+05:30")).when(k == 2, written(-300, "-0500"))
            .when(k == 3, written(60, " +01"))
            .when((k == 4) & clear, F.concat(F.date_format(ny, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                                             F.lit(" [America/New_York]")))
            .otherwise(written(0, "")))
    d = e.select("event_id", text.alias("written"))
    return d.select("event_id", F.date_format(IO.utc_naive(d, "written"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
                    .alias("utc"))


@query("ticker_slug")
def q_slug(spark, sf_dir):
    """File-safe names of every panel's tickers."""
    t = (requested_tickers(spark, sf_dir).join(
            panel_daily(spark, sf_dir).groupBy("ticker").agg(F.count(F.lit(1)).alias("n_bars")),
            "ticker", "left").withColumn("n_bars", F.coalesce("n_bars", F.lit(0)))
         .unionByName(panel_hourly(spark, sf_dir).groupBy("ticker")
                      .agg(F.count(F.lit(1)).alias("n_bars"))))
    return t.select("ticker", IO.ticker_slug("ticker").alias("slug"), "n_bars")


@query("write_panel_parquet")
def q_write_parquet(spark, sf_dir):
    """Write partitioned by ticker, read back."""
    path = IO.scratch_path(spark, "panel")
    IO.write_panel_parquet(panel_daily(spark, sf_dir), path)
    return spark_round(IO.read_panel(spark, path).select("ticker", "date", *OHLCV))


@query("write_panel_csv")
def q_write_csv(spark, sf_dir):
    """CSV with 4 decimals, read back as text."""
    path = IO.scratch_path(spark, "panel-csv")
    p = panel_daily(spark, sf_dir).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    IO.write_panel_csv(p, path)
    return IO.read_panel_csv(spark, path).select("ticker", "date", *OHLC, "volume")


@query("write_processed_csv")
def q_write_processed_csv(spark, sf_dir):
    """Scaled splits as CSV with 6 decimals, read back as text."""
    path = IO.scratch_path(spark, "processed-csv")
    sc = _prepared(spark, sf_dir)["scaled"].withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    keys = ("ticker", "split")
    IO.write_panel_csv(sc.select(*keys, "date", *OHLCV), path, 6, OHLCV, keys)
    return IO.read_panel_csv(spark, path, keys).select(*keys, "date", *OHLCV)


@query("require_columns")
def q_require_columns(spark, sf_dir):
    """The price columns of the panel, whatever their case and company."""
    p = panel_daily(spark, sf_dir)
    odd = p.select("ticker", "date", *[F.col(c).alias(c.upper()) for c in OHLCV])
    return spark_round(IO.require_columns(odd))


# NaN is missing ---------------------------------------------------------------
def _nan(spark, sf_dir):
    return _dirty(spark, sf_dir, "nan")


@query("nan_null_rate")
def q_nan_null_rate(spark, sf_dir):
    """Q1 on a panel whose gaps are NaN."""
    return spark_round(QL.null_rates(_nan(spark, sf_dir)), default=RATIO)


@query("nan_validate_gate")
def q_nan_gate(spark, sf_dir):
    """Q2 on a panel whose gaps are NaN."""
    g = QL.validate_gate(_nan(spark, sf_dir), requested=requested_tickers(spark, sf_dir))
    return spark_round(g.select("ticker", "n_rows", "max_null_rate", "ok"), default=RATIO)


@query("nan_ffill")
def q_nan_ffill(spark, sf_dir):
    """Q4 on a panel whose gaps are NaN."""
    d = materialize(QL.drop_all_null_prices(_nan(spark, sf_dir)))
    d = QL.forward_fill(d, OHLC, layout_for(d, ["seq"]))
    return spark_round(d.select("ticker", "seq", "date", *OHLC))


def _nan_clean(spark, sf_dir):
    raw = materialize(_nan(spark, sf_dir))
    return materialize(QL.clean_panel(raw, layout_for(raw, ["seq"])))


@query("nan_clean_panel")
def q_nan_clean(spark, sf_dir):
    """Q8 on a panel whose gaps are NaN."""
    return spark_round(_nan_clean(spark, sf_dir).select("ticker", "date", *OHLCV))


@query("nan_target_next_up")
def q_nan_target(spark, sf_dir):
    """W9 on a panel whose gaps are NaN: no return, no rise."""
    p = materialize(_nan(spark, sf_dir).filter("rev = 1"))
    lay = layout_for(p).with_halo(2, 2)
    d = lay.prepare(p.select("ticker", "date", *OHLCV))
    d = lay.finish(Wn.target_next_up(Wn.log_return(d, lay), lay), keep_ordinal=False)
    return spark_round(d.select("ticker", "date", "target"))


@query("nan_feature_frame")
def q_nan_features(spark, sf_dir):
    """F1 on the cleaned panel whose gaps were NaN."""
    p = _nan_clean(spark, sf_dir)
    f = FT.feature_frame(p, layout_for(p))
    return spark_round(f.select("ticker", "date", *FEATURE_COLS, "target"))


# Replacing one ticker ---------------------------------------------------------
class _Broken(RuntimeError):
    pass


def _rewrite_one(write, df, ticker, change):
    """Everything, then one ticker changed, then a write that fails midway
    (another ticker's rows, a division by zero in the last of them)."""
    write(df)
    write(df.filter(F.col("ticker") == ticker).withColumns(change))
    broken = df.filter(F.col("ticker") == "5-LOW").withColumns(
        {c: F.lit(1.0) / F.when(F.col("date") > "1998-01-01", 0).otherwise(1)
         for c in list(change)[:1]})
    try:
        write(broken)
    except Exception:  # noqa: BLE001  ANSI raises in the task
        return
    raise _Broken("the broken write should have failed")


@query("replace_ticker")
def q_replace_ticker(spark, sf_dir):
    """One ticker rewritten at twice its prices; the others, and the one
    whose rewriting failed, as they were."""
    path = IO.scratch_path(spark, "panel")
    _rewrite_one(lambda d: IO.write_panel_parquet(d, path), panel_daily(spark, sf_dir), "2-HIGH",
                 {c: F.col(c) * 2 for c in OHLC})
    return spark_round(IO.read_panel(spark, path).select("ticker", "date", *OHLCV))


@query("replace_ticker_csv")
def q_replace_ticker_csv(spark, sf_dir):
    """As ``replace_ticker`` for the CSV panel."""
    path = IO.scratch_path(spark, "panel-csv")
    p = panel_daily(spark, sf_dir).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    _rewrite_one(lambda d: IO.write_panel_csv(d, path), p, "2-HIGH",
                 {c: F.col(c) * 2 for c in OHLC})
    return IO.read_panel_csv(spark, path).select("ticker", "date", *OHLC, "volume")


@query("replace_processed")
def q_replace_processed(spark, sf_dir):
    """One split of one ticker rewritten; its other splits stay."""
    path = IO.scratch_path(spark, "processed")
    d = _prepared(spark, sf_dir)["scaled"].select("ticker", "split", "date", "close", "target")
    IO.write_processed(d, path)
    IO.write_processed(d.filter("ticker = '2-HIGH' AND split = 'val'")
                       .withColumn("close", -F.col("close")), path)
    return spark_round(IO.read_processed(spark, path), {"close": RATIO})


@query("replace_sequences")
def q_replace_sequences(spark, sf_dir):
    """One ticker's test windows rewritten with their targets turned."""
    path = IO.scratch_path(spark, "sequences")
    d = _prepared(spark, sf_dir)["sequences"]
    IO.write_sequences(d, path)
    IO.write_sequences(d.filter("ticker = '3-MEDIUM' AND split = 'test'")
                       .withColumn("y", 1 - F.col("y")), path)
    return IO.read_sequences(spark, path).groupBy("ticker", "split").agg(
        F.count(F.lit(1)).alias("n_seq"), F.sum("y").cast("bigint").alias("n_up"))


@query("replace_scaler")
def q_replace_scaler(spark, sf_dir):
    """F8: one ticker's params rewritten; the others stay."""
    path = IO.scratch_path(spark, "scaler")
    params = _prepared(spark, sf_dir)["params"]
    FT.save_scaler(params, path)
    FT.save_scaler(params.filter("ticker = '2-HIGH'").withColumn("max_close", F.lit(1.0)), path)
    return spark_round(FT.load_scaler(spark, path).select("ticker", "min_close", "max_close"),
                       default=4)


@query("collection_manifest")
def q_manifest(spark, sf_dir):
    """Gate the dirty panel, clean the passing tickers, report."""
    raw = materialize(_dirty(spark, sf_dir))  # read by the gate and the cleaning
    gate = QL.validate_gate(raw, requested=requested_tickers(spark, sf_dir))
    valid = QL.keep_valid(raw, gate)
    clean = QL.clean_panel(valid, layout_for(raw, ["seq"]))
    return IO.collection_manifest(gate, clean, "2024-01-31T00:00:00+00:00",
                                  {"start": "1995-01-01", "end": "2001-12-31"})


@query("manifest_json")
def q_manifest_json(spark, sf_dir):
    """S8 with S2: sources of which one lacks a column and one has too many gaps;
    the collection's manifest as one JSON object."""
    d = _dirty(spark, sf_dir)
    tickers = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
    frames = {t: d.filter(F.col("ticker") == t).drop("ticker") for t in tickers}
    frames["2-HIGH"] = frames["2-HIGH"].drop("volume")
    raw, sources = IO.collect_sources(frames, keep=("date", "seq"))
    raw = materialize(raw)
    gate = QL.validate_gate(raw, requested=sources)
    valid = QL.keep_valid(raw, gate)
    clean = QL.clean_panel(valid, layout_for(raw, ["seq"]))
    m = IO.collection_manifest(gate, clean, "2024-01-31T00:00:00+00:00",
                               {"start": "1995-01-01", "end": "2001-12-31"}, sources=sources)
    path = f"{IO.scratch_path(spark, 'manifest')}/meta.json"
    IO.publish_manifest(m, path)
    kind = ("collected_at string, parameters struct<start:string,end:string>, tickers array<string>, "
            "results map<string,struct<status:string,rows:bigint,start:string,end:string>>")
    back = spark.read.text(path, wholetext=True)  # what a reader of the file finds
    return back.select(F.to_json(F.from_json("value", kind)).alias("manifest"))


@query("write_processed")
def q_write_processed(spark, sf_dir):
    """Scaled splits stored per (ticker, split), read back."""
    st = _prepared(spark, sf_dir)
    path = IO.scratch_path(spark, "processed")
    IO.write_processed(st["scaled"].select("ticker", "split", "date", *FEATURE_COLS, "target"), path)
    back = IO.read_processed(spark, path)
    return spark_round(back.select("ticker", "date", "split", *FEATURE_COLS, "target"),
                       digits={c: RATIO for c in FEATURE_COLS})


@query("sequence_store")
def q_seq_store(spark, sf_dir):
    """Store every ticker's tensors, load one ticker back by partition."""
    st = _prepared(spark, sf_dir)
    path = IO.scratch_path(spark, "sequences")
    IO.write_sequences(st["sequences"], path)
    back = IO.load_sequences(spark, path, "3-MEDIUM")
    return back.groupBy("ticker", "split").agg(
        F.count(F.lit(1)).alias("n_seq"), F.sum("y").cast("bigint").alias("n_up"),
        F.round(F.sum(F.element_at(F.element_at("seq", -1), 4).cast("double")), RATIO).alias("sum_last_close"))


@query("window_store")
def q_window_store(spark, sf_dir):
    """S10/W10 in blocks of rows: windows cut out on reading, of every ticker."""
    path = IO.scratch_path(spark, "window-blocks")
    IO.write_window_blocks(FT.window_blocks(_prepared(spark, sf_dir)["scaled"]), path)
    back = IO.load_windows(spark, path, 30)
    close = F.transform("seq", lambda x: F.element_at(x, 4).cast("double"))
    return back.select("ticker", "split", F.date_format("date", "yyyy-MM-dd").alias("date"), "y",
                       F.size("seq").alias("n"),
                       F.round(F.element_at(close, 1), RATIO).alias("first_close"),
                       F.round(F.element_at(close, -1), RATIO).alias("last_close"))


@query("clustered_features")
def q_clustered(spark, sf_dir):
    """The panel clustered by ticker, opened again, and its features for a
    range of dates computed without an exchange."""
    from barpanel.sources.clustered import read_clustered, write_clustered
    path = IO.scratch_path(spark, "clustered")
    write_clustered(panel_daily(spark, sf_dir), path, 8)
    p = IO.scan_panel(read_clustered(spark, path), None, "1996-01-01", "1999-01-01")
    f = FT.feature_frame(p)
    return spark_round(f.select("ticker", "date", *FEATURE_COLS, "target"))


@query("prepare_store")
def q_prepare_store(spark, sf_dir):
    """F10 with S9, F8, S10: the preparation stored for every requested ticker, one of
    them rewritten alone afterwards; what the stores hold, per ticker and split."""
    from barpanel.operators.jobs import prepare_to_store
    panel = materialize(panel_daily(spark, sf_dir))
    root = IO.scratch_path(spark, "prepared")
    lay = layout_for(panel)
    report = prepare_to_store(panel, root, lay, requested=requested_tickers(spark, sf_dir))
    report = materialize(report)
    prepare_to_store(panel.filter("ticker = '2-HIGH'"), root, lay)
    rows = IO.read_processed(spark, f"{root}/processed").groupBy("ticker", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("close"), 3).alias("sum_close"))
    windows = IO.load_windows(spark, f"{root}/windows", 30).groupBy("ticker", "split").agg(
        F.count(F.lit(1)).alias("n_windows"), F.sum("y").cast("bigint").alias("n_up"))
    scaler = FT.load_scaler(spark, f"{root}/scaler").select(
        "ticker", F.round("min_close", 4).alias("min_close"), F.round("max_close", 4).alias("max_close"))
    return (FT.requested_splits(report).join(report.select("ticker", "status"), "ticker")
            .join(rows, ["ticker", "split"], "left").join(windows, ["ticker", "split"], "left")
            .join(scaler, "ticker", "left"))
