"""Registered Spark ML queries (M1-M9). Model fits are iterative, so these
have no SQL oracle (``run_log`` and ``model_registry`` have): the driver checks
rows, our tests check properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from barpanel.constants import FEATURE_COLS
from barpanel.operators import features as FT
from barpanel.operators import metrics as M
from barpanel.operators import models as ML
from barpanel.plans.present import RATIO
from barpanel.plans.queries import _prepared, query
from barpanel.sources import panel_io as IO

WINDOW = 30


def _seqs(spark, sf_dir):
    """The windows, stored once per job by (ticker, split)."""
    path = IO.scratch_path(spark, "sequences")
    IO.write_sequences(_prepared(spark, sf_dir)["sequences"], path)
    return IO.read_sequences(spark, path)


def _split(s, name):
    return s.filter(F.col("split") == name)


_fitted: dict = {}


def forget() -> None:
    """Drops the fitted model that the tree queries share."""
    _fitted.clear()


def _source_state(spark, sf_dir):
    """Names, sizes and times of the files behind the panel: a rewritten input
    is another state."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/orders.parquet")
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return (spark.sparkContext.applicationId, *sorted(
        (f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


def _fit_gbt(spark, sf_dir):
    """The windows and the tree model with the full defaults. M1-M4, M7 and M9
    look at the same model, so it is fitted once per state of the source."""
    key = _source_state(spark, sf_dir)
    if key not in _fitted:
        forget()
        s = _seqs(spark, sf_dir)
        _fitted[key] = s, ML.build_model("gbt").fit(_split(s, "train"), _split(s, "val"))
    return _fitted[key]


def _pred_out(pred):
    return pred.select("ticker", "split", F.date_format("date", "yyyy-MM-dd").alias("date"),
                       "y", F.round("p", RATIO).alias("p"), "pred")


@query("train_gbt")
def q_m1(spark, sf_dir):
    """M1: one boosted-tree model on every ticker's train windows; metrics."""
    s, m = _fit_gbt(spark, sf_dir)
    return m.evaluate(s)


@query("gbt_best_round")
def q_m2(spark, sf_dir):
    """M2: validation loss per round and the round chosen with patience."""
    _, m = _fit_gbt(spark, sf_dir)
    return m.history.select("step", F.round("train_loss", RATIO).alias("train_loss"),
                            F.round("val_loss", RATIO).alias("val_loss"),
                            F.lit(m.best_round).alias("best_round"))


@query("predict_gbt")
def q_m3(spark, sf_dir):
    """M3: label and P(up) for every window."""
    s, m = _fit_gbt(spark, sf_dir)
    return _pred_out(m.predict(s))


@query("gbt_importances")
def q_m4(spark, sf_dir):
    """M4: importance per (lag, feature), and its sum per feature."""
    _, m = _fit_gbt(spark, sf_dir)
    imp = m.importances(WINDOW)
    from pyspark.sql import Window
    return imp.withColumn("feature_total", F.sum("importance").over(Window.partitionBy("feature")))


@query("train_mlp")
def q_m5(spark, sf_dir):
    """M5: feed-forward network on the flattened windows; metrics."""
    s = _seqs(spark, sf_dir)
    m = ML.build_model("mlp").fit(_split(s, "train"), _split(s, "val"))
    return m.evaluate(s)


@query("train_per_ticker")
def q_m6(spark, sf_dir):
    """M6: one GBT per ticker (concurrent jobs), models and predictions stored as
    they are done; metrics of every ticker in one job."""
    s = _seqs(spark, sf_dir)
    tickers = sorted(r[0] for r in s.select("ticker").distinct().collect())
    path = IO.scratch_path(spark, "per-ticker")
    ML.train_per_ticker(s, "gbt", tickers, path=path)
    p = ML.predictions_of(spark, path)
    rounds = p.groupBy("ticker").agg(F.max("best_round").alias("best_round"))
    return M.evaluate(p, by=("ticker", "split")).join(rounds, "ticker")


@query("model_store")
def q_m7(spark, sf_dir):
    """M7: save, load, predict again: predictions identical."""
    s, m = _fit_gbt(spark, sf_dir)
    path = IO.scratch_path(spark, "model-gbt")
    m.save(path)
    m2 = ML.GBTModel.load(path)
    a = m.predict(s).select("ticker", "split", "date", F.col("p").alias("p_before"))
    b = m2.predict(s).select("ticker", "split", "date", F.col("p").alias("p_after"))
    j = a.join(b, ["ticker", "split", "date"])
    return j.select("ticker", "split", F.date_format("date", "yyyy-MM-dd").alias("date"),
                    F.round("p_before", RATIO).alias("p_before"),
                    (F.col("p_before") == F.col("p_after")).alias("identical"))


@query("run_log")
def q_m8(spark, sf_dir):
    """M8: the linear scorer's run: model, window, counts per ticker and split
    and all metrics, appended to the runs table and read back."""
    s = _seqs(spark, sf_dir)
    scores = M.score_sequences(s, WINDOW)
    counts = s.groupBy("ticker", "split").agg(F.count(F.lit(1)).alias("n"))
    rows = ML.run_log_rows("linear-all", "train", {
        "model": "linear", "asset": "all", "window": WINDOW, "n_features": len(FEATURE_COLS),
        "features": FEATURE_COLS, "shuffle": False}, M.evaluate(scores), None, spark, counts)
    path = IO.scratch_path(spark, "runs")
    ML.append_runs(rows, path)
    return ML.read_runs(spark, path).drop("run_id").withColumn("value", F.round("value", 4))


@query("run_log_retries")
def q_m8_retries(spark, sf_dir):
    """M8: a run logged, logged again by a retry, and a second run: the first
    stands once in the table, with the rows of the retry."""
    s = _seqs(spark, sf_dir)
    counts = s.groupBy("ticker", "split").agg(F.count(F.lit(1)).alias("n"))
    path = IO.scratch_path(spark, "runs")
    for run_id, window in (("run-1", 1), ("run-1", WINDOW), ("run-2", WINDOW)):
        ML.append_runs(ML.run_log_rows("counts", "data", {"window": window}, None, None, spark,
                                       counts), path, run_id)
    return ML.read_runs(spark, path).select("run_id", "key", "value")


@query("run_log_gbt")
def q_m8_gbt(spark, sf_dir):
    """M8 for the tree model: every parameter, counts, metrics, importances and
    the learning curve."""
    s, m = _fit_gbt(spark, sf_dir)
    counts = s.groupBy("ticker", "split").agg(F.count(F.lit(1)).alias("n"))
    rows = ML.run_log_rows("gbt-all", "train", {
        "model": m.kind, "asset": "all", "window": WINDOW, **m.config,
        "best_round": m.best_round}, m.evaluate(s), m.history, spark, counts,
        m.importances(WINDOW))
    path = IO.scratch_path(spark, "runs")
    ML.append_runs(rows, path)
    return ML.read_runs(spark, path).drop("run_id").withColumn("value", F.round("value", RATIO))


@query("model_registry")
def q_m10(spark, sf_dir):
    """The models by name and what each trains on from the panel."""
    s = _seqs(spark, sf_dir)
    per = s.groupBy("split").agg(F.count(F.lit(1)).alias("n_windows"))
    names = spark.createDataFrame([(k, c.kind) for k, c in ML.MODEL_REGISTRY.items()],
                                  "name string, kind string")
    return (names.withColumn("split", F.explode(F.array(*[F.lit(x) for x in FT.SPLITS])))
            .join(per, "split").select("name", "kind", "split", "n_windows"))


@query("learning_curve")
def q_m9(spark, sf_dir):
    """M9: loss per boosting round (train and val)."""
    _, m = _fit_gbt(spark, sf_dir)
    return m.history.select(F.lit("gbt-all").alias("run"), "step",
                            F.round("train_loss", RATIO).alias("train_loss"),
                            F.round("val_loss", RATIO).alias("val_loss"))


@query("learning_curve_mlp")
def q_m9_mlp(spark, sf_dir):
    """M9 for the network family: loss per epoch (train and val), and the epoch
    whose weights are kept."""
    s = _seqs(spark, sf_dir)
    m = ML.build_model("mlp").fit(_split(s, "train"), _split(s, "val"))
    return m.history.select(F.lit("mlp-all").alias("run"), "step",
                            F.round("train_loss", RATIO).alias("train_loss"),
                            F.round("val_loss", RATIO).alias("val_loss"),
                            F.lit(m.best_round).alias("best_epoch"))


#: Trials per (model, ticker) in this query; the operator has no default (see README
#: for the time and memory of a trial).
HPO_TRIALS = 8


@query("hpo_gbt")
def q_hpo_gbt(spark, sf_dir):
    """H3-H6 for the tree model: a study per ticker over the full tree space,
    kept in a ledger. The first call stops in the middle of a study; the second
    runs the missing trials only; the best trial of each study is scored once on
    test."""
    from barpanel.operators import search as H
    s = _seqs(spark, sf_dir)
    studies = s.select(F.col("ticker").alias("study")).distinct()
    path = IO.scratch_path(spark, "ml-study")
    H.resume_models(s, studies, HPO_TRIALS, path, budget=HPO_TRIALS // 2)
    out = H.resume_models(s, studies, HPO_TRIALS, path)
    return out.select("study", "trial", F.round("value", 4).alias("value"), "val_sharpe",
                      "val_mae", "state", "is_best",
                      *[c for c in out.columns if c.startswith("test_")])


# Spark ML pipelines -------------------------------------------------------------
@query("pipeline_windows")
def q_pipeline_windows(spark, sf_dir):
    """Features, split, scaling and windows as Spark ML stages, fitted, saved,
    loaded, and applied to the bars again."""
    from pyspark.ml import Pipeline, PipelineModel

    from barpanel.operators import stages as ST
    from barpanel.plans.queries import laid_panel
    panel, _ = laid_panel(spark, sf_dir)
    path = IO.scratch_path(spark, "pipeline")
    Pipeline(stages=[ST.PanelFeatures(), ST.ChronoSplit(), ST.PanelScaler(),
                     ST.SlidingWindows(window=WINDOW)]).fit(panel).save(path)
    w = PipelineModel.load(path).transform(panel)
    close = F.transform("seq", lambda x: F.element_at(x, 4).cast("double"))
    return w.select("ticker", "split", F.date_format("date", "yyyy-MM-dd").alias("date"), "y",
                    F.size("seq").alias("n"),
                    F.round(F.element_at(close, 1), RATIO).alias("first_close"),
                    F.round(F.element_at(close, -1), RATIO).alias("last_close"))


def _pipeline_scores(spark, sf_dir, kind, config):
    from pyspark.ml import PipelineModel

    from barpanel.operators.stages import direction_pipeline
    from barpanel.plans.queries import laid_panel
    panel, _ = laid_panel(spark, sf_dir)
    fitted = direction_pipeline(kind, config).fit(panel)
    path = IO.scratch_path(spark, f"pipeline-{kind}")
    fitted.save(path)
    a = fitted.transform(panel).select("ticker", "split", "date", "y", "p", "pred")
    b = PipelineModel.load(path).transform(panel).select(
        "ticker", "split", "date", F.col("p").alias("p_loaded"))
    j = a.join(b, ["ticker", "split", "date"])
    return j.select(
        "ticker", "split", F.date_format("date", "yyyy-MM-dd").alias("date"), "y",
        F.round("p", RATIO).alias("p"), "pred", (F.col("p") == F.col("p_loaded")).alias("identical"))


@query("pipeline_gbt")
def q_pipeline_gbt(spark, sf_dir):
    """One pipeline from bars to P(up) with boosted trees (40 of depth 4);
    saved, loaded, the same scores."""
    return _pipeline_scores(spark, sf_dir, "gbt", {"maxIter": 40, "maxDepth": 4})


@query("pipeline_mlp")
def q_pipeline_mlp(spark, sf_dir):
    """As ``pipeline_gbt`` with the network."""
    return _pipeline_scores(spark, sf_dir, "mlp", {})
