"""Model contract, save/load, sources and the driver entry points."""

import pytest
from pyspark.sql import functions as F

from barpanel.operators import features as FT
from barpanel.operators import models as ML
from barpanel.plans.layout import PLAIN
from barpanel.sources import panel_io as IO

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def seqs(daily):
    return FT.prepare_panel(daily, PLAIN, window=10)["sequences"].persist()


def test_predict_before_fit_raises(seqs):
    with pytest.raises(ML.NotTrainedError):
        ML.build_model("gbt").predict(seqs)


def test_unknown_model_raises():
    with pytest.raises(ValueError):
        ML.build_model("nope")


def test_config_merge():
    m = ML.build_model("gbt", {"maxDepth": 2})
    assert m.config["maxDepth"] == 2 and m.config["maxIter"] == ML.GBT_DEFAULTS["maxIter"]


def test_gbt_fit_predict_save_load(spark, seqs, tmp_path):
    tr = seqs.filter(F.col("split") == "train")
    va = seqs.filter(F.col("split") == "val")
    m = ML.build_model("gbt", {"maxIter": 3, "maxDepth": 2}).fit(tr, va)
    p = m.predict(seqs).toPandas()
    assert p["p"].between(0, 1).all() and set(p["pred"]) <= {0, 1}
    assert not p["p"].isna().any()
    path = IO.scratch_path(spark, "test-model")
    m.save(path)
    p2 = ML.GBTModel.load(path).predict(seqs).toPandas()
    assert (p.sort_values(["ticker", "date"])["p"].values == p2.sort_values(["ticker", "date"])["p"].values).all()
    e = m.evaluate(seqs).toPandas()
    assert (e["rmse"] >= e["mae"]).all()


def test_stopping_rule():
    """A strict minimum counts; patience 3 rounds without one ends it."""
    assert ML.first_minimum([5, 4, 4, 4.5, 4, 1], 3) == (2, 5)
    assert ML.first_minimum([5, 4, 3], 3) == (3, 3)
    assert ML.first_minimum([3, 4, 5], 2) == (1, 3)


def test_early_stopping_keeps_the_first_trees(spark, seqs):
    """Patience below the number of rounds: the model ends at the validation
    minimum, and its trees are the first ones of the long fit."""
    tr, va = (seqs.filter(F.col("split") == x) for x in ("train", "val"))
    cfg = {"maxIter": 16, "maxDepth": 2, "stepSize": 0.5, "early_stopping_rounds": 3,
           "subsamplingRate": 1.0}
    m = ML.build_model("gbt", cfg).fit(tr, va)
    curve = [r.val_loss for r in m.history.orderBy("step").collect()]
    assert ML.first_minimum(curve, 3) == (m.best_round, len(curve))
    assert m.model.getNumTrees == m.best_round
    # the curve is the binary log-loss of the kept trees on val
    from barpanel.operators import metrics as M
    loss = m.predict(va).agg(M.log_loss()).first()[0]
    assert loss == pytest.approx(curve[m.best_round - 1], rel=1e-6)


def test_longer_fits_and_no_second_fit_of_the_kept_trees(spark, seqs, monkeypatch):
    """Ensembles grow by three; the trees up to the minimum are cut from the last,
    not fitted again."""
    sizes, real = [], ML.GBTModel._estimator

    def sized(self, n_features, train, max_iter=None):
        sizes.append(max_iter)
        return real(self, n_features, train, max_iter)
    monkeypatch.setattr(ML.GBTModel, "_estimator", sized)
    tr, va = (seqs.filter(F.col("split") == x) for x in ("train", "val"))
    cfg = {"maxDepth": 2, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
    m = ML.build_model("gbt", {**cfg, "maxIter": 18, "early_stopping_rounds": 3}).fit(tr, tr)
    assert sizes == [6, 18] and m.best_round == m.model.getNumTrees == 18
    sizes.clear()
    # steps far too long: the minimum comes at once
    m = ML.build_model("gbt", {**cfg, "maxIter": 12, "early_stopping_rounds": 3,
                               "stepSize": 1.0}).fit(tr, va.withColumn("y", 1 - F.col("y")))
    assert sizes[0] == 6 and m.best_round not in sizes and m.best_round == m.model.getNumTrees


def test_first_trees_score_save_and_load(spark, seqs):
    one = seqs.filter("ticker = '2-HIGH'").coalesce(1)
    tr = one.filter("split = 'train'")
    data = ML.build_model("gbt").prepare(tr)
    try:
        long, short = (ML.build_model("gbt", {"maxDepth": 3})._estimator(
            data.n_features, data.train, k).fit(data.train) for k in (5, 2))
    finally:
        data.release()
    m = ML.build_model("gbt", {"maxDepth": 3})
    m.model = ML.first_trees(long, 2)
    assert m.model.getNumTrees == 2 and m.model.getMaxDepth() == long.getMaxDepth()

    def scores(of):
        return {r.date: r.p for r in of.predict(one).collect()}
    want = ML.build_model("gbt")
    want.model = short
    path = m.save(IO.scratch_path(spark, "test-first"))
    assert scores(m) == scores(want) == scores(ML.GBTModel.load(path))
    # importances have a row per lag and feature, also without any split
    same = [{(r.lag, r.feature): r.importance for r in x.importances(10).collect()}
            for x in (m, want)]
    assert len(same[0]) == 180 and same[0] == pytest.approx(same[1])
    flat = ML.build_model("gbt", {"minInfoGain": 9.0, "maxIter": 2}).fit(tr)
    flat.model = ML.first_trees(flat.model, 1)
    assert {r.importance for r in flat.importances(10).collect()} == {0.0}


def test_fits_do_not_carry_the_plan_of_their_vectors(seqs):
    for kind in ("gbt", "mlp"):
        data = ML.build_model(kind).prepare(*(seqs.filter(F.col("split") == x)
                                              for x in ("train", "val")))
        try:
            for d in (data.train, data.val):
                plan = d._jdf.queryExecution().logical().toString()
                assert "LogicalRDD" in plan and "Join" not in plan and "Relation" not in plan
        finally:
            data.release()


def test_defaults_are_full_size():
    c = ML.build_model("gbt").config
    assert (c["maxIter"], c["maxDepth"], c["early_stopping_rounds"]) == (300, 6, 30)
    assert ML.build_model("mlp").config["epochs"] == 50


def test_mlp_uses_validation(spark, seqs):
    tr, va = (seqs.filter(F.col("split") == x) for x in ("train", "val"))
    m = ML.build_model("mlp", {"hidden": [4], "epochs": 6, "patience": 2, "steps_per_epoch": 3}).fit(tr, va)
    h = m.history.orderBy("step").collect()
    assert 1 <= m.best_round <= len(h) <= 6
    best = min(r.val_loss for r in h)
    assert h[m.best_round - 1].val_loss <= best + 6e-4
    assert h[0].train_loss > h[-1].train_loss


def test_per_ticker_models_and_missing_ticker(spark, seqs):
    path = IO.scratch_path(spark, "test-stored")
    IO.write_sequences(seqs, path)
    stored = IO.read_sequences(spark, path)
    got = ML.train_per_ticker(stored, "gbt", ["2-HIGH", "5-LOW"], {"maxIter": 2, "maxDepth": 2})
    assert set(got) == {"2-HIGH", "5-LOW"} and all(m.model for m in got.values())
    with pytest.raises(ValueError):
        ML.train_per_ticker(stored, "gbt", ["NO-SUCH"], {"maxIter": 2})


def test_per_ticker_models_are_stored_as_they_are_done(spark, seqs, monkeypatch):
    path = IO.scratch_path(spark, "test-stored")
    IO.write_sequences(seqs, path)
    stored = IO.read_sequences(spark, path)
    out = IO.scratch_path(spark, "test-per-ticker")
    cfg = {"maxIter": 2, "maxDepth": 2}
    with pytest.raises(ValueError):  # what is done before the failure stays
        ML.train_per_ticker(stored, "gbt", ["2-HIGH", "NO-SUCH"], cfg, 1, out)
    fits, real = [], ML.GBTModel.fit_prepared
    monkeypatch.setattr(ML.GBTModel, "fit_prepared",
                        lambda self, data: fits.append(1) or real(self, data))
    got = ML.train_per_ticker(stored, "gbt", ["2-HIGH", "5-LOW"], cfg, 2, out)
    assert len(fits) == 1 and set(got) == {"2-HIGH", "5-LOW"}
    p = ML.predictions_of(spark, out)
    assert {r.ticker for r in p.select("ticker").distinct().collect()} == {"2-HIGH", "5-LOW"}
    for t, m in got.items():
        want = {(r.split, r.date): r.p for r in m.predict(stored.filter(F.col("ticker") == t)).collect()}
        assert {(r.split, r.date): r.p for r in p.filter(F.col("ticker") == t).collect()} == want


def test_run_log_keeps_everything(spark):
    rows = {r.key: r for r in ML.run_log_rows("r", "train", {
        "a": 1, "s": "x", "l": [1, 2], "b": True}, spark=spark).collect()}
    assert rows["param.a"].value == 1.0 and rows["param.s"].text == "x"
    assert rows["param.l"].text == "[1, 2]" and rows["param.b"].text == "true"


def test_no_silent_local_scratch(monkeypatch):
    """Without a shared folder a cluster session raises."""
    from barpanel import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_manifest_covers_requested_tickers(spark):
    gate = spark.createDataFrame([("A", True), ("B", False), ("C", True)], "ticker string, ok boolean")
    clean = spark.createDataFrame([("A", "2020-01-02"), ("A", "2020-01-05")], "ticker string, date string")
    rows = {r.ticker: r for r in IO.collection_manifest(
        gate, clean.withColumn("date", F.to_date("date")), "now", {"x": 1}).collect()}
    assert (rows["A"].status, rows["A"].rows, rows["A"].end) == ("OK", 2, "2020-01-05")
    assert rows["B"].status == rows["C"].status == "FAILED"
    assert rows["A"].collected_at == "now" and rows["A"].parameters == '{"x":1}'


def test_reports_cover_short_and_absent_tickers(spark, daily):
    """A ticker of 20 bars has no complete row, one is absent: FAIL, 0 rows."""
    short = daily.filter("ticker = '5-LOW'").orderBy("date").limit(20).withColumn(
        "ticker", F.lit("SHORT"))
    panel = daily.filter("ticker = '2-HIGH'").unionByName(short)
    asked = spark.createDataFrame([("2-HIGH",), ("SHORT",), ("GONE",)], "ticker string")
    st = FT.prepare_panel(panel, PLAIN, window=10)
    got = {(r.ticker, r.split): r for r in FT.prepare_report(st, asked).collect()}
    assert len(got) == 9
    assert all(got[t, s].status == "FAIL" and got[t, s].n_seq == 0
               for t in ("SHORT", "GONE") for s in FT.SPLITS)
    assert all(got["2-HIGH", s].status == "OK" and got["2-HIGH", s].n_seq > 0 for s in FT.SPLITS)
    bounds = {(r.ticker, r.split): r.n_rows for r in FT.split_bounds(st["split"], requested=asked).collect()}
    assert bounds["GONE", "val"] == 0 and bounds["SHORT", "train"] == 0
    leak = {r.ticker: r.ok for r in FT.leakage_check(st["split"], requested=asked).collect()}
    assert leak == {"2-HIGH": True, "SHORT": False, "GONE": False}


def test_scaling_of_new_rows(spark, daily):
    """A stored scaler scales rows that it was not fitted on."""
    st = FT.prepare_panel(daily, PLAIN, window=10)
    path = IO.scratch_path(spark, "test-scaler")
    FT.save_scaler(st["params"], path)
    new = st["split"].limit(5).withColumn("close", F.col("close") + 1000.0)
    got = FT.apply_minmax(new, FT.load_scaler(spark, path))
    p = {r.ticker: r for r in st["params"].collect()}
    raw = {(r.ticker, r.date): r.close for r in new.collect()}
    for r in got.collect():
        lo, hi = p[r.ticker]["min_close"], p[r.ticker]["max_close"]
        assert r.close == pytest.approx((raw[r.ticker, r.date] - lo) / (hi - lo))


def test_queries_leave_nothing_cached(spark):
    """Operators do not persist: repeated runs cost the same."""
    import __spark_entry__ as E
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    for _ in range(2):
        E.queries()["prepare_panel"](spark, SF001).count()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_require_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "Open double, High double")
    with pytest.raises(IO.MissingColumnsError):
        IO.require_columns(df)


def test_partition_pruning(spark, daily):
    path = IO.scratch_path(spark, "test-panel")
    IO.write_panel_parquet(daily, path)
    q = IO.read_panel(spark, path, ["2-HIGH"], "1996-01-01", "1997-01-01")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "2-HIGH" in plan and "1-URGENT" not in plan and "PushedFilters: [IsNotNull(date)" in plan
    assert {f.split("ticker=")[1].split("/")[0] for f in q.inputFiles()} == {"2-HIGH"}
    assert q.select("ticker").distinct().count() == 1


def test_load_missing_sequences_raises(spark, seqs):
    path = IO.scratch_path(spark, "test-seq")
    IO.write_sequences(seqs, path)
    with pytest.raises(IO.MissingDataError):
        IO.load_sequences(spark, path, "NO-SUCH")


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "n_seq" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 90
