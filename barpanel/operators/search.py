"""Hyper-parameter search with trials as data (H1-H6).

* H1: trials are rows generated in Spark. Every (study, trial, parameter) has a
  draw of its own, ``u`` = the first 32 bits of the md5 of ``study|trial|
  parameter|seed`` over 2^32, mapped to int / float / log-float / categorical
  ranges: independent, portable and without a limit on dimensions or trials.
  Random search (the reference's TPE sampler is sequential: not built).
* H3: a *formula* model (momentum over n days against a threshold) is scored
  for every trial in one pass over the validation rows. The trials of a study
  travel as arrays of at most ``TRIALS_PER_ROW`` structs; rows meet them by an
  equi-join on the study, are exploded in the same stage and aggregated
  map-side per (study, trial). The plan's size does not depend on the number of
  trials and nothing is collected.
* K2 picks the best trial; H5 re-scores it once on the test split; H6 joins
  the leaderboard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barpanel.functions import scalars as P
from barpanel.operators import metrics as M

SEED = 42
TRIALS_PER_ROW = 256


def uniform(study, trial, parameter: str, seed: int = SEED) -> Column:
    """A number in [0, 1) drawn for (study, trial, parameter, seed)."""
    text = F.concat_ws("|", P.col(study).cast("string"), P.col(trial).cast("string"),
                       F.lit(parameter), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def int_param(u: Column, lo: int, hi: int) -> Column:
    return (F.lit(lo) + F.floor(u * F.lit(hi - lo + 1))).cast("int")


def float_param(u: Column, lo: float, hi: float) -> Column:
    return F.lit(lo) + u * F.lit(hi - lo)


def log_param(u: Column, lo: float, hi: float) -> Column:
    a, b = math.log(lo), math.log(hi)
    return F.exp(F.lit(a) + u * F.lit(b - a))


def cat_param(u: Column, choices) -> Column:
    arr = F.array(*[F.lit(c) for c in choices])
    return F.element_at(arr, (F.floor(u * F.lit(len(choices))) + 1).cast("int"))


# --- search spaces --------------------------------------------------------
# The formula model.
MOMENTUM_SPACE = {"n_mom": ("int", 2, 20), "thr": ("float", -0.02, 0.02),
                  "scale": ("log", 0.001, 0.1), "side": ("cat", ["long", "contrarian"])}
# Ranges of the tree and network models, and what is added to
# every configuration of a model.
TREE_SPACE = {"n_estimators": ("int", 100, 500), "max_depth": ("int", 3, 8),
              "learning_rate": ("log", 1e-3, 0.3), "subsample": ("float", 0.6, 1.0),
              "colsample_bytree": ("float", 0.6, 1.0), "min_child_weight": ("int", 1, 10),
              "gamma": ("float", 0.0, 1.0), "reg_alpha": ("log", 1e-4, 10.0),
              "reg_lambda": ("log", 1e-4, 10.0)}
LSTM_SPACE = {"hidden_size": ("cat", [32, 64, 128, 256]), "num_layers": ("int", 1, 3),
              "dropout": ("float", 0.0, 0.5), "learning_rate": ("log", 1e-4, 1e-2),
              "batch_size": ("cat", [32, 64, 128]), "grad_clip": ("float", 0.5, 5.0)}
TCN_SPACE = {"n_dilation_levels": ("int", 3, 6), "num_channels": ("cat", [32, 64, 128]),
             "kernel_size": ("cat", [2, 3, 5]), "dropout": ("float", 0.0, 0.5),
             "learning_rate": ("log", 1e-4, 1e-2), "batch_size": ("cat", [32, 64, 128]),
             "grad_clip": ("float", 0.5, 5.0)}
TFT_SPACE = {"n_heads": ("cat", [2, 4, 8]), "d_model_factor": ("int", 1, 4),
             "lstm_layers": ("int", 1, 2), "dropout": ("float", 0.0, 0.4),
             "learning_rate": ("log", 1e-4, 1e-2), "batch_size": ("cat", [32, 64, 128]),
             "grad_clip": ("float", 0.5, 5.0)}
SPACES = {"xgboost": TREE_SPACE, "lstm": LSTM_SPACE, "tcn": TCN_SPACE, "tft": TFT_SPACE}
NET_CONSTANTS = {"epochs": 50, "patience": 10, "random_state": 42}
TREE_CONSTANTS = {"early_stopping_rounds": 30}


def sample_trials(studies: DataFrame, n_trials: int, space: dict, seed: int = SEED,
                  study: str = "study") -> DataFrame:
    """H1: ``n_trials`` configurations per study row (trial 0..n-1)."""
    t = studies.select(study, F.explode(F.sequence(F.lit(0), F.lit(n_trials - 1))).alias("trial"))
    t = t.withColumn("trial", F.col("trial").cast("bigint"))
    kinds = {"int": int_param, "float": float_param, "log": log_param, "cat": cat_param}
    return t.withColumns({name: kinds[kind](uniform(study, "trial", name, seed), *args)
                          for name, (kind, *args) in space.items()})


def derived_params(trials: DataFrame) -> DataFrame:
    """H2: dilations = [2^i, i < levels]; d_model = n_heads·8·factor;
    receptive field of the dilated stack; constants merged."""
    out = trials
    if "n_dilation_levels" in trials.columns:
        dil = F.transform(F.sequence(F.lit(0), F.col("n_dilation_levels") - 1),
                          lambda i: F.pow(F.lit(2), i).cast("int"))
        out = out.withColumn("dilations", dil).withColumn(
            "receptive_field", (F.col("kernel_size") - 1) * F.aggregate(
                F.col("dilations"), F.lit(0), lambda a, x: a + x) + 1)
    if "n_heads" in trials.columns:
        out = out.withColumn("d_model", F.col("n_heads") * F.lit(8) * F.col("d_model_factor"))
    constants = dict(NET_CONSTANTS)
    if "n_estimators" in trials.columns:
        constants |= TREE_CONSTANTS
    return out.withColumns({k: F.lit(v) for k, v in constants.items()})


# --- the formula model ------------------------------------------------------
def momentum_columns(df: DataFrame, layout, ns, price: str = "close") -> DataFrame:
    """mom_n = price_t / price_{t-n} - 1 for every n (window lags)."""
    from barpanel.operators.windows import lag
    return df.withColumns({f"mom_{n}": F.try_divide(P.col(price), lag(layout, price, n)) - F.lit(1.0)
                           for n in ns})


def momentum_proba(mom: Column, thr, scale, side) -> Column:
    z = (mom - P.col(thr)) / P.col(scale)
    p_long = P.sigmoid(z)
    return F.when(P.col(side) == "contrarian", F.lit(1.0) - p_long).otherwise(p_long)


def score_trials(rows: DataFrame, trials: DataFrame, ns, key: str = "ticker",
                 study: str = "study", y: str = "target") -> DataFrame:
    """Probability of every row of a study under every trial of that study:
    (key, trial, y, p, pred). Trials: study, trial, n_mom, thr, scale, side."""
    packed = (trials.select(F.col(study).alias(key), "trial", "n_mom", "thr", "scale", "side")
              .groupBy(key, F.floor(F.col("trial") / F.lit(TRIALS_PER_ROW)).alias("_part"))
              .agg(F.collect_list(F.struct("trial", "n_mom", "thr", "scale", "side")).alias("_t")))
    # the momenta become one array before the trials multiply the rows
    moms = F.array(*[F.col(f"mom_{n}") for n in ns])
    lengths = F.array(*[F.lit(k) for k in ns])
    place = (F.array_position(lengths, F.col("t.n_mom")) - 1).cast("int")
    j = (rows.select(key, F.col(y).cast("double").alias("y"), moms.alias("_moms"))
         .join(packed.drop("_part"), key)
         .withColumn("t", F.explode("_t")).drop("_t"))
    p = momentum_proba(F.get("_moms", place), F.col("t.thr"), F.col("t.scale"), F.col("t.side"))
    return (j.select(key, F.col("t.trial").alias("trial"), "y", p.alias("p"))
            .withColumn("pred", (F.col("p") >= 0.5).cast("double")))


def evaluate_trials(rows: DataFrame, trials: DataFrame, ns, key: str = "ticker",
                    study: str = "study", y: str = "target") -> DataFrame:
    """H3: objective = directional accuracy per (study, trial); also Sharpe
    and MAE. A trial without rows scores 0.0."""
    scored = score_trials(rows, trials, ns, key, study, y)
    got = scored.groupBy(F.col(key).alias(study), "trial").agg(
        M.directional_accuracy().alias("value"), M.sharpe().alias("val_sharpe"),
        M.mae().alias("val_mae"))
    return (trials.join(got, [study, "trial"], "left")
            .withColumn("value", F.coalesce("value", F.lit(0.0))))


def best_on_test(rows_test: DataFrame, best: DataFrame, ns, key: str = "ticker") -> DataFrame:
    """H5: the best trial of each study scored once on the test rows."""
    scored = score_trials(rows_test, best, ns, key).withColumn("split", F.lit("test"))
    return M.evaluate(scored, by=(key, "split"))


# --- ML trials ---------------------------------------------------------------
def tree_config(params: dict) -> dict:
    """A tree configuration of the space in Spark ML's names. Spark ML has no
    L1 / L2 terms, so ``reg_alpha`` and ``reg_lambda`` stay in the study only."""
    names = {"n_estimators": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize",
             "subsample": "subsamplingRate", "min_child_weight": "minInstancesPerNode",
             "gamma": "minInfoGain"}
    out = {names[k]: v for k, v in params.items() if k in names}
    if "colsample_bytree" in params:
        out["featureSubsetStrategy"] = str(round(float(params["colsample_bytree"]), 4))
    if "early_stopping_rounds" in params:
        out["early_stopping_rounds"] = params["early_stopping_rounds"]
    return out


def in_turn(tasks: list, studies: int = 8) -> list:
    """The order in which (study, trial) pairs are run: so many studies at a time,
    since a small study's vectors lie on one executor and only several studies
    keep all executors busy; of these the trials with the most tree levels first,
    so that no long one is left for the end."""
    place = {study: k // studies for k, study in enumerate(dict.fromkeys(s for s, _ in tasks))}

    def key(task):
        study, t = task
        return place[study], -t.get("n_estimators", 0) * t.get("max_depth", 0), t["trial"]
    return sorted(tasks, key=key)


def run_trials(stored: DataFrame, tasks: list, ledger, name: str = "gbt",
               base: dict | None = None, threads: int | None = None) -> int:
    """H3 for ML models: fits the (study, trial) pairs of ``tasks`` that nobody has
    finished or claimed, as concurrent Spark jobs from one thread pool over all
    studies, and commits each as it ends; objective = validation directional
    accuracy. A fit is a row of short jobs that mostly wait for their turn, so
    there are two threads per core of the cluster, 8 at least, unless ``threads``
    says otherwise; see :func:`in_turn` for the order. Trials of a small study are
    one task each (:mod:`barpanel.operators.boosting`). The train and val vectors of
    a study are prepared and persisted
    once, for all of its trials, and released after the last. A trial that fails
    scores 0.0 and keeps its error in ``state``. A model better than all before it
    in its study is saved. Returns the number of trials run here."""
    from collections import Counter
    from concurrent.futures import ThreadPoolExecutor
    from threading import Lock

    from barpanel.operators import models as ML
    threads = threads or max(8, 2 * stored.sparkSession.sparkContext.defaultParallelism)
    tasks = in_turn(tasks)
    left = Counter(study for study, _ in tasks)
    lock = {study: Lock() for study in left}
    prepared: dict = {}
    best: dict = {}

    def data(study):
        with lock[study]:
            if study not in prepared:
                seqs = stored.filter(F.col("ticker") == study)
                prepared[study] = ML.build_model(name).prepare_trials(
                    *(seqs.filter(F.col("split") == x) for x in ("train", "val")))
                best[study] = ledger.best(study) or (None, -1.0)
            return prepared[study]

    def done(study):
        with lock[study]:
            left[study] -= 1
            if not left[study] and study in prepared:
                prepared.pop(study).release()

    def one(task):
        study, t = task
        try:
            if not ledger.claim(study, t["trial"]):
                return 0
            cfg = {**(base or {}), **tree_config({k: v for k, v in t.items() if k != "trial"})}
            try:
                vectors = data(study)
                m = ML.build_model(name, cfg).fit_prepared(vectors)
                r = M.evaluate(m.predict(vectors.val), by=()).first()
            except Exception as e:  # noqa: BLE001  the error is part of the study
                ledger.commit(study, t["trial"], 0.0, state=f"FAIL: {type(e).__name__}: {e}"[:500])
                return 1
            except BaseException:
                ledger.release(study, t["trial"])
                raise
            value = float(r["directional_accuracy"] or 0.0)
            with lock[study]:
                if best[study][0] is None or (value, -t["trial"]) > (best[study][1], -best[study][0]):
                    m.save(_model_path(ledger, study, t["trial"]))
                    best[study] = t["trial"], value
            ledger.commit(study, t["trial"], value, r["sharpe_ratio"], r["mae"])
            return 1
        finally:
            done(study)

    try:
        with ThreadPoolExecutor(max_workers=max(1, min(threads, len(tasks)))) as ex:
            return sum(ex.map(one, tasks))
    finally:
        for p in prepared.values():
            p.release()


def run_study(stored: DataFrame, study: str, trials: list, ledger, name: str = "gbt",
              base: dict | None = None, threads: int | None = None) -> int:
    """H3/H5: the trials of one study, then its best trial's test metrics."""
    n = run_trials(stored, [(study, t) for t in trials], ledger, name, base, threads)
    score_best(stored, study, trials, ledger, name)
    return n


def _model_path(ledger, study: str, trial: int) -> str:
    from urllib.parse import quote
    return f"{ledger.path}/models/{quote(study, safe='')}/{trial:08d}"


def score_best(stored: DataFrame, study: str, trials: list, ledger, name: str) -> None:
    """H5: the best trial's test metrics, once all trials of the study are in and
    nobody has scored it."""
    from barpanel.operators import models as ML
    if not {(study, t["trial"]) for t in trials} <= ledger.finished(study):
        return
    best = ledger.best(study)
    if best is None or (study, best[0]) in ledger.tested(study):
        return
    path = _model_path(ledger, study, best[0])
    fs_path = ledger._Path(path)
    if not ledger._fs.exists(fs_path):  # every trial failed
        return
    test = stored.filter((F.col("ticker") == study) & (F.col("split") == "test"))
    r = M.evaluate(ML.MODEL_REGISTRY[name].load(path).predict(test), by=("split",)).first()
    ledger.commit_test(study, best[0], {m: r[m] if r is not None else None for m in M.METRICS})


def resume_models(stored: DataFrame, studies: DataFrame, n_trials: int, path: str,
                  name: str = "gbt", base: dict | None = None, seed: int = SEED,
                  threads: int | None = None, budget: int | None = None, lease: float = 120.0) -> DataFrame:
    """One study per (model, ticker) of ``studies`` with ``n_trials`` trials of
    the tree space, kept in a ledger at ``path``: trials finished there are not
    run again, and other searchers may work on the same path. ``stored``: windows
    partitioned by (ticker, split). ``budget`` ends this call after so many
    trials. Returns the ledger's rows with ``is_best`` and, for finished studies,
    the best trial's test metrics."""
    from barpanel.operators.ledger import TrialLedger
    spark = stored.sparkSession
    ledger = TrialLedger(spark, path, lease)
    wanted = derived_params(sample_trials(studies, n_trials, TREE_SPACE, seed))
    todo: dict[str, list] = {}
    for r in wanted.orderBy("study", "trial").collect():  # configurations, not data
        t = r.asDict()
        todo.setdefault(t.pop("study"), []).append(t)
    finished = {study: ledger.finished(study) for study in todo}
    tasks = [(study, t) for study, trials in todo.items() for t in trials
             if (study, t["trial"]) not in finished[study]]
    run_trials(stored, tasks[:budget], ledger, name, base, threads)
    for study, trials in todo.items():
        score_best(stored, study, trials, ledger, name)
    got, tests = ledger.rows(), ledger.tests()
    best = got.groupBy("study").agg(F.max_by(
        "trial", F.struct(F.col("value"), -F.col("trial"))).alias("best"))
    return (got.join(best, "study").withColumn("is_best", F.col("trial") == F.col("best"))
            .join(tests.select("study", "trial", "metrics"), ["study", "trial"], "left")
            .select("study", "trial", "value", "val_sharpe", "val_mae", "state", "is_best",
                    *[F.col("metrics")[m].alias(f"test_{m}") for m in M.METRICS]))
