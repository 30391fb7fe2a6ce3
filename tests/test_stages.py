"""Spark ML stages, stored window blocks and clustered panels."""

import os

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from barpanel.operators import features as FT
from barpanel.operators import models as ML
from barpanel.operators import stages as ST
from barpanel.plans.layout import PLAIN
from barpanel.sources import panel_io as IO
from barpanel.sources.clustered import read_clustered, write_clustered

WINDOW = 10


def keyed(df, *cols):
    rows = {(r["ticker"], r["split"], r["date"]): tuple(r[c] for c in cols) for r in df.collect()}
    assert len(rows) == df.count()
    return rows


@pytest.fixture(scope="module")
def prepared(daily):
    return FT.prepare_panel(daily, PLAIN, window=WINDOW)


# -- stages --------------------------------------------------------------------

def test_stages_give_the_windows_of_prepare_panel(spark, daily, prepared):
    p = Pipeline(stages=[ST.PanelFeatures(), ST.ChronoSplit(), ST.PanelScaler(),
                         ST.SlidingWindows(window=WINDOW)]).fit(daily)
    want = keyed(prepared["sequences"], "seq", "y")
    assert keyed(p.transform(daily), "seq", "y") == want and want
    path = IO.scratch_path(spark, "test-pipeline")
    p.save(path)
    again = PipelineModel.load(path)
    assert [type(s) for s in again.stages] == [type(s) for s in p.stages]
    assert again.stages[3].getOrDefault("window") == WINDOW
    assert keyed(again.transform(daily), "seq", "y") == want


def test_blocked_stages_equal_plain_ones(spark, daily, prepared):
    p = Pipeline(stages=[ST.PanelFeatures(blockRows=100), ST.ChronoSplit(blockRows=100),
                         ST.PanelScaler(blockRows=100),
                         ST.SlidingWindows(window=WINDOW, blockRows=100)]).fit(daily)
    got, want = keyed(p.transform(daily), "y"), keyed(prepared["sequences"], "y")
    assert got == want


def test_scaler_learns_from_train_and_is_kept(spark, daily, prepared):
    split = prepared["split"]
    model = ST.PanelScaler().fit(split)
    path = IO.scratch_path(spark, "test-scaler")
    model.save(path)
    again = ST.PanelScalerModel.load(path)
    assert sorted(again.bounds.collect()) == sorted(FT.fit_minmax(split).collect())
    shifted = split.withColumn("close", F.col("close") * 2)  # new data, old bounds
    a = keyed(again.transform(shifted), "close")
    b = keyed(FT.apply_minmax(shifted, FT.fit_minmax(split)), "close")
    assert a == b


@pytest.mark.parametrize("kind, config", [
    ("gbt", {"maxIter": 3, "maxDepth": 2}),
    ("mlp", {"hidden": [4], "epochs": 2, "steps_per_epoch": 2})])
def test_whole_pipeline_is_saved_and_scores_the_same(spark, daily, kind, config):
    p = ST.direction_pipeline(kind, config, WINDOW).fit(daily)
    path = IO.scratch_path(spark, f"test-pipeline-{kind}")
    p.save(path)
    again = PipelineModel.load(path)
    m = again.stages[-1].model
    assert m.kind == kind and m.best_round == p.stages[-1].model.best_round
    assert {k: m.config[k] for k in config} == config
    want = keyed(p.transform(daily), "p", "pred")
    assert keyed(again.transform(daily), "p", "pred") == want
    assert all(0 <= x <= 1 and y in (0, 1) for x, y in want.values())


def test_unknown_params_raise(spark):
    with pytest.raises(TypeError):
        ST.SlidingWindows(windows=3)
    with pytest.raises(ValueError, match="depth"):
        ST.GBTDirection(config='{"depth": 3}')
    with pytest.raises(ValueError, match="unknown settings"):
        ML.build_model("mlp", {"layers": [3]})
    with pytest.raises(ValueError):
        ST.direction_pipeline("lstm")


def test_params_of_stages_are_saved(spark):
    path = IO.scratch_path(spark, "test-stage")
    ST.SlidingWindows(window=7, key="asset", blockRows=9).save(path)
    s = ST.SlidingWindows.load(path)
    assert (s.getOrDefault("window"), s.getOrDefault("key"), s.getOrDefault("blockRows")) == (
        7, "asset", 9)


# -- windows in blocks ------------------------------------------------------------

@pytest.mark.parametrize("block", [1, 7, 10, 64, 4096])
def test_windows_of_blocks_equal_sliding_sequences(spark, prepared, block):
    blocks = FT.window_blocks(prepared["scaled"], WINDOW, block)
    got = FT.windows_of_blocks(blocks, WINDOW, block)
    assert keyed(got, "seq", "y") == keyed(prepared["sequences"], "seq", "y")
    assert blocks.agg(F.max(F.size("rows"))).first()[0] <= block + WINDOW


def test_short_splits_have_no_window(spark, prepared):
    few = prepared["scaled"].filter("_pos < 4")
    blocks = FT.window_blocks(few, WINDOW, 64)
    assert FT.windows_of_blocks(blocks, WINDOW, 64).count() == 0
    assert FT.windows_of_blocks(blocks.limit(0), WINDOW, 64).count() == 0


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path.removeprefix("file:"))
               for f in fs if f.endswith(".parquet"))


def test_blocks_take_little_more_than_the_rows(spark, daily01):
    """Stored bytes within 1.5 x of the scaled rows; windows kept whole take far more."""
    st = FT.prepare_panel(daily01, PLAIN)
    rows, blocks, whole = (IO.scratch_path(spark, f"test-{k}") for k in ("rows", "blocks", "whole"))
    cols = [F.col(c).cast("float").alias(c) for c in FT.FEATURE_COLS]
    one = st["scaled"].select("ticker", "split", "date", *cols, "target")
    IO.write_processed(one.coalesce(1), rows)
    IO.write_window_blocks(FT.window_blocks(st["scaled"]).coalesce(1), blocks)
    IO.write_sequences(st["sequences"].coalesce(1), whole)
    assert size_of(blocks) < 1.5 * size_of(rows)
    assert size_of(whole) > 3 * size_of(blocks)  # dictionary encoding hides most copies
    a = IO.load_windows(spark, blocks, 30, tickers="2-HIGH", splits="val")
    assert a.count() == IO.load_sequences(spark, whole, "2-HIGH", "val").count() > 0


def test_rewriting_one_split_of_blocks(spark, prepared):
    path = IO.scratch_path(spark, "test-blocks")
    scaled = prepared["scaled"]
    IO.write_window_blocks(FT.window_blocks(scaled, WINDOW), path)
    turned = scaled.filter("ticker = '2-HIGH' AND split = 'val'").withColumn("target", 1 - F.col("target"))
    IO.write_window_blocks(FT.window_blocks(turned, WINDOW), path)
    want = {k: (1 - y if k[:2] == ("2-HIGH", "val") else y,)
            for k, (y,) in keyed(prepared["sequences"], "y").items()}
    assert keyed(IO.load_windows(spark, path, WINDOW), "y") == want


# -- clustered panels -------------------------------------------------------------

def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_of_a_clustered_panel_need_no_exchange(spark, daily):
    path = IO.scratch_path(spark, "test-clustered")
    write_clustered(daily, path, 4)
    spark.sql(f"DROP TABLE {__import__('barpanel.sources.clustered', fromlist=['x'])._name(path)}")
    p = read_clustered(spark, path)  # as another session would
    f = FT.feature_frame(p)
    assert "Exchange" not in plan_of(f) and "Exchange" in plan_of(FT.feature_frame(daily))
    cols = f.columns
    assert sorted(map(str, f.collect())) == sorted(map(str, FT.feature_frame(daily).select(cols).collect()))


def test_date_range_opens_only_its_row_groups(spark, daily01):
    path = IO.scratch_path(spark, "test-groups")
    write_clustered(daily01, path, 2, row_group_bytes=8 << 10)
    total = daily01.count()
    q = IO.scan_panel(read_clustered(spark, path), ["2-HIGH"], "1996-01-01", "1996-03-01")
    assert q.count() == daily01.filter(
        "ticker = '2-HIGH' AND date >= '1996-01-01' AND date < '1996-03-01'").count() > 0
    plan = q._jdf.queryExecution().executedPlan()
    q.collect()
    text = plan.toString()
    assert "PushedFilters" in text and "GreaterThanOrEqual(date" in text
    leaves = plan.collectLeaves()
    scan = leaves.apply(0)
    read = scan.metrics().apply("numOutputRows").value()
    assert 0 < read < total / 2


# -- the whole preparation ---------------------------------------------------------

def test_prepare_to_store_leaves_out_what_fails_the_gate(spark, daily, prepared):
    from barpanel.operators.jobs import prepare_to_store
    root = IO.scratch_path(spark, "test-prepared")
    few = daily.filter("ticker <> '5-LOW'").unionByName(
        daily.filter("ticker = '5-LOW'").orderBy("date").limit(52))  # three complete rows
    report = {r.ticker: r for r in prepare_to_store(few, root, window=WINDOW).collect()}
    assert report["5-LOW"].status == "FAIL" and report["2-HIGH"].status == "OK"
    stored = IO.read_processed(spark, f"{root}/processed")
    assert "5-LOW" not in {r.ticker for r in stored.select("ticker").distinct().collect()}
    assert report["2-HIGH"].n_val == stored.filter("ticker = '2-HIGH' AND split = 'val'").count()
    prepare_to_store(daily.filter("ticker = '5-LOW'"), root, window=WINDOW)  # its bars are complete now
    got = keyed(IO.load_windows(spark, f"{root}/windows", WINDOW), "seq", "y")
    assert got == keyed(prepared["sequences"], "seq", "y")
    assert FT.load_scaler(spark, f"{root}/scaler").count() == 5
