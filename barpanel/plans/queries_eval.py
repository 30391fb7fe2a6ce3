"""Registered queries for arrays / scoring (P5-P13), evaluation (A), selection
(K) and the search (H)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from barpanel.constants import FEATURE_COLS
from barpanel.functions import scalars as P
from barpanel.operators import features as FT
from barpanel.operators import metrics as M
from barpanel.operators import search as H
from barpanel.operators import selection as K
from barpanel.plans.present import METRIC, RATIO, spark_round
from barpanel.plans.queries import _prepared, laid_panel, query
from barpanel.sources import panel_io as IO
from barpanel.sources.fixtures import table

WINDOW = 30
N_TRIALS = 40
MOM_NS = list(range(2, 21))
PATIENCE = 10


def _seqs(spark, sf_dir):
    return _prepared(spark, sf_dir)["sequences"]


def _scores(spark, sf_dir):
    return M.score_sequences(_seqs(spark, sf_dir), WINDOW)


def _d(c="date"):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


# P ---------------------------------------------------------------------------
@query("to_float32_int64")
def q_p5(spark, sf_dir):
    """P5: tensor cells as FLOAT, label as BIGINT."""
    s = _seqs(spark, sf_dir)
    return s.select("ticker", "split", _d(),
                    F.round(F.element_at(F.element_at("seq", 1), 1).cast("double"), RATIO).alias("x_first"),
                    F.col("y").cast("bigint").alias("y"))


@query("flatten_window")
def q_p6(spark, sf_dir):
    """Flattened window (oldest day first)."""
    s = _seqs(spark, sf_dir).withColumn("flat", P.flatten_window("seq"))
    return s.select("ticker", "split", _d(), F.size("flat").cast("int").alias("n_flat"),
                    F.round(F.element_at("flat", 271).cast("double"), RATIO).alias("flat_271"),
                    F.round(F.element_at("flat", -1).cast("double"), RATIO).alias("flat_last"))


@query("seq_last_step")
def q_p7(spark, sf_dir):
    """The last step's close, rsi and volume_norm."""
    s = _seqs(spark, sf_dir).withColumn("last", P.last_step("seq"))
    return s.select("ticker", "split", _d(),
                    *[F.round(F.element_at("last", i).cast("double"), RATIO).alias(n)
                      for i, n in ((4, "last_close"), (13, "last_rsi"), (18, "last_volume_norm"))])


@query("seq_mean_pool")
def q_p8(spark, sf_dir):
    """Mean over time of close and rsi."""
    s = _seqs(spark, sf_dir).withColumn("mp", P.mean_pool("seq", len(FEATURE_COLS)))
    return s.select("ticker", "split", _d(),
                    F.round(F.element_at("mp", 4), RATIO).alias("mean_close"),
                    F.round(F.element_at("mp", 13), RATIO).alias("mean_rsi"))


def _scored_rows(spark, sf_dir):
    sc = _prepared(spark, sf_dir)["scaled"]
    return sc.withColumn("scores", F.array(*[F.col(c) for c in FEATURE_COLS]))


@query("softmax_weights")
def q_p9(spark, sf_dir):
    """Softmax across the 18 scaled features of every row."""
    s = M.with_softmax(_scored_rows(spark, sf_dir), "scores", "w")
    return s.select("ticker", _d(), F.round(F.array_max("w"), RATIO).alias("w_max"),
                    F.round(F.aggregate("w", F.lit(0.0), lambda a, x: a + x), RATIO).alias("w_sum"),
                    F.array_position("w", F.array_max("w")).cast("int").alias("w_argmax"))


@query("weighted_combine")
def q_p10(spark, sf_dir):
    """P10: Σ softmax(scores)_i · scores_i."""
    s = M.with_softmax(_scored_rows(spark, sf_dir), "scores", "w")
    return s.select("ticker", _d(), F.round(P.weighted_sum("w", "scores"),
                                            RATIO).alias("combined"))


@query("threshold_label")
def q_p11(spark, sf_dir):
    """P11."""
    s = _scores(spark, sf_dir)
    return s.select("ticker", "split", _d(), F.round("p", RATIO).alias("p"), "pred")


@query("direction_signal")
def q_p12(spark, sf_dir):
    """±1 signal and realised ±1 return."""
    s = _scores(spark, sf_dir)
    return s.select("ticker", "split", _d(), P.direction_signal("pred").alias("signal"),
                    P.realised_return("pred", "y").alias("realised"))


@query("linear_score")
def q_p13(spark, sf_dir):
    """P(up) of every window from the stored weight vector."""
    s = _scores(spark, sf_dir)
    return s.select("ticker", "split", _d(), "y", F.round("p", RATIO).alias("p"))


# A ---------------------------------------------------------------------------
def _metric(spark, sf_dir, name, col):
    s = _scores(spark, sf_dir)
    return s.groupBy("ticker", "split").agg(F.round(col, METRIC).alias(name))


@query("directional_accuracy")
def q_a1(spark, sf_dir):
    return _metric(spark, sf_dir, "directional_accuracy", M.directional_accuracy())


@query("mae")
def q_a2(spark, sf_dir):
    return _metric(spark, sf_dir, "mae", M.mae())


@query("rmse")
def q_a3(spark, sf_dir):
    return _metric(spark, sf_dir, "rmse", M.rmse())


@query("sharpe_ratio")
def q_a4(spark, sf_dir):
    return _metric(spark, sf_dir, "sharpe_ratio", M.sharpe())


@query("log_loss")
def q_a10(spark, sf_dir):
    return _metric(spark, sf_dir, "log_loss", M.log_loss())


@query("evaluate_all")
def q_a5(spark, sf_dir):
    """A5: the four metrics per (model, ticker, split)."""
    e = M.evaluate(_scores(spark, sf_dir))
    return e.select(F.lit("linear").alias("model"), "*")


@query("metrics_long")
def q_a6(spark, sf_dir):
    """train_/val_/test_ prefixed metrics, one row each."""
    return M.metrics_long(M.evaluate(_scores(spark, sf_dir)))


@query("result_table")
def q_a7(spark, sf_dir):
    """Test summary per ticker."""
    return M.result_table(M.evaluate(_scores(spark, sf_dir)))


@query("class_balance")
def q_a8(spark, sf_dir):
    """On the train windows."""
    s = _seqs(spark, sf_dir).filter(F.col("split") == "train")
    b = M.class_balance(s)
    return b.withColumn("scale_pos_weight", F.round("scale_pos_weight", RATIO))


@query("feature_importance_mean")
def q_a9(spark, sf_dir):
    """Mean softmax importance of each feature over windows and steps."""
    imp = M.feature_importance_mean(_prepared(spark, sf_dir)["scaled"], WINDOW)
    return imp.select("feature", F.round("importance", RATIO).alias("importance"))


# K ---------------------------------------------------------------------------
@query("sort_panel")
def q_k1(spark, sf_dir):
    """K1: date position of every bar within its ticker."""
    p, lay = laid_panel(spark, sf_dir)
    s = K.sort_panel(p, lay, "pos")
    return s.select("ticker", _d(), "pos")


# H ---------------------------------------------------------------------------
def _studies(spark, sf_dir):
    """One study per ticker, with the bars that it searches on."""
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("study")).agg(
        F.countDistinct(F.to_date("o_orderdate")).alias("n_bars"))


def _trials(spark, sf_dir, n=N_TRIALS):
    return H.sample_trials(_studies(spark, sf_dir), n, H.MOMENTUM_SPACE)


def _search_rows(spark, sf_dir):
    """Features, momenta and splits of every row, written once per study job:
    validation and test rows are read from there."""
    p, lay = laid_panel(spark, sf_dir)
    cols = [f"mom_{n}" for n in MOM_NS]
    feats = FT.feature_frame(p, lay,
                             extra=lambda df, l: H.momentum_columns(df, l, MOM_NS),
                             extra_cols=cols)
    rows = FT.chrono_split(feats, lay).select("ticker", "date", "split", "target", *cols)
    path = IO.scratch_path(spark, "search-rows")
    rows.write.partitionBy("split").parquet(path)
    return spark.read.parquet(path)


def _study_results(spark, sf_dir, trial_filter=None, rows=None):
    rows = _search_rows(spark, sf_dir) if rows is None else rows
    trials = _trials(spark, sf_dir)
    if trial_filter is not None:
        trials = trials.filter(trial_filter)
    return H.evaluate_trials(rows.filter(F.col("split") == "val"), trials, MOM_NS), rows


@query("sample_trials")
def q_h1(spark, sf_dir):
    """H1: 40 momentum-model configurations per study (ticker)."""
    t = _trials(spark, sf_dir).join(_studies(spark, sf_dir), "study")
    return t.select("study", "trial", "n_bars", "n_mom", F.round("thr", RATIO + 2).alias("thr"),
                    F.round("scale", RATIO + 2).alias("scale"), "side")


@query("derived_params")
def q_h2(spark, sf_dir):
    """H2: configurations of all four models with derived dilations / d_model."""
    st = _studies(spark, sf_dir)
    ints = ["n_estimators", "max_depth", "min_child_weight", "hidden_size", "num_layers",
            "num_channels", "kernel_size", "receptive_field", "n_heads", "d_model", "lstm_layers",
            "batch_size", "epochs", "patience", "random_state", "early_stopping_rounds"]
    reals = ["learning_rate", "subsample", "colsample_bytree", "gamma", "reg_alpha", "reg_lambda",
             "dropout", "grad_clip"]
    out = None
    for model, space in H.SPACES.items():
        t = H.derived_params(H.sample_trials(st, N_TRIALS, space))
        cols = [F.col(c).cast("int").alias(c) if c in t.columns
                else F.lit(None).cast("int").alias(c) for c in ints]
        cols += [F.round(c, RATIO).alias(c) if c in t.columns
                 else F.lit(None).cast("double").alias(c) for c in reals]
        dil = F.array_join("dilations", ",") if "dilations" in t.columns else F.lit(None).cast("string")
        t = t.select("study", "trial", F.lit(model).alias("model"), dil.alias("dilations"), *cols)
        out = t if out is None else out.unionByName(t)
    return out.join(st, "study")


def _round_results(r):
    return r.select("study", "trial", F.round("value", METRIC).alias("value"),
                    F.round("val_sharpe", METRIC).alias("val_sharpe"),
                    F.round("val_mae", METRIC).alias("val_mae"))


@query("evaluate_trials")
def q_h3(spark, sf_dir):
    """H3: every trial scored on the validation rows in one grouped pass."""
    res, _ = _study_results(spark, sf_dir)
    return _round_results(res)


@query("resume_study")
def q_h4(spark, sf_dir):
    """H4: a stored partial study (first 15 trials) is resumed: only the
    remaining trials (anti join against the store) are evaluated."""
    first, rows = _study_results(spark, sf_dir, F.col("trial") < 15)
    path = IO.scratch_path(spark, "study")
    first.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    remaining = _trials(spark, sf_dir).join(stored.select("study", "trial"),
                                            ["study", "trial"], "left_anti")
    more = H.evaluate_trials(rows.filter(F.col("split") == "val"), remaining, MOM_NS)
    return _round_results(stored.unionByName(more.select(*stored.columns)))


@query("best_trial")
def q_k2(spark, sf_dir):
    """K2: best trial per study (ties -> lowest trial)."""
    res, _ = _study_results(spark, sf_dir)
    b = K.best_trial(res.select("study", "trial", "value"))
    return b.select("study", "trial", F.round("value", METRIC).alias("value"), "n_trials")


@query("early_stop_round")
def q_k3(spark, sf_dir):
    """K3: early stopping replayed over each study's loss curve
    (loss = 1 - validation accuracy in trial order), patience 10."""
    res, _ = _study_results(spark, sf_dir)
    curves = res.select(F.col("study").alias("run"), F.col("trial").alias("step"),
                        (F.lit(1.0) - F.col("value")).alias("val"))
    r = K.early_stop(curves, PATIENCE)
    return r.select("run", "stop_step", "best_step", F.round("best_val", METRIC).alias("best_val"),
                    "stopped_early")


@query("best_on_test")
def q_h5(spark, sf_dir):
    """H5: the best trial of each study scored once on the test rows."""
    res, rows = _study_results(spark, sf_dir)
    best = K.best_trial(res.select("study", "trial", "value", "n_mom", "thr", "scale", "side"))
    test = rows.filter(F.col("split") == "test")
    return H.best_on_test(test, best, MOM_NS)


@query("study_leaderboard")
def q_h6(spark, sf_dir):
    """H6: best value, trial, trial count and test metrics per (model, study)."""
    res, rows = _study_results(spark, sf_dir)
    best = K.best_trial(res.select("study", "trial", "value", "n_mom", "thr", "scale", "side"))
    test = H.best_on_test(rows.filter(F.col("split") == "test"), best, MOM_NS)
    t = test.select(F.col("ticker").alias("study"),
                    *[F.col(m).alias(f"test_{m}") for m in M.METRICS])
    lb = best.join(t, "study").select(
        F.lit("momentum").alias("model"), "study", F.col("trial").alias("best_trial"),
        F.round("value", METRIC).alias("best_value"), "n_trials", *[f"test_{m}" for m in M.METRICS])
    return lb
