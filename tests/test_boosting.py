"""Boosting in one task: the trees of Spark ML, without its jobs."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from barpanel.operators import boosting as B
from barpanel.operators import models as ML


def windows(spark, n, seed, split):
    """Windows of 4 days of 5 features: one constant, one mostly 0, one of few values."""
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4, 5)).round(3)
    x[:, :, 1] = 0.25
    x[:, :, 2] *= rng.random((n, 4)) < 0.2
    x[:, :, 3] = np.floor(x[:, :, 3] * 4)
    y = (x[:, 3, 0] + x[:, 2, 4] + 0.6 * rng.random(n) > 1.4).astype(int)
    rows = [(str(i), split, s.tolist(), int(k)) for i, (s, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "date string, split string, seq array<array<float>>, y int"
                                 ).withColumn("ticker", F.lit("t")).coalesce(1)


@pytest.fixture(scope="module")
def prepared(spark):
    data = ML.GBTModel().prepare_trials(windows(spark, 400, 1, "train"), windows(spark, 90, 2, "val"))
    yield data
    data.release()


def by_spark(data, model):
    rows, data.rows = data.rows, None
    try:
        return model.fit_prepared(data)
    finally:
        data.rows = rows


def lines(m):
    """Conditions and predictions of a model's trees."""
    text = [x.strip() for x in m.model.toDebugString.split("\n")[1:]]
    return ([x for x in text if "Predict" not in x],
            [float(x.split()[-1]) for x in text if "Predict" in x])


@pytest.mark.parametrize("config", [
    {"maxIter": 25, "maxDepth": 5, "featureSubsetStrategy": "0.6132"},
    {"maxIter": 12, "maxDepth": 8, "subsamplingRate": 1.0, "featureSubsetStrategy": "1.0",
     "stepSize": 0.3},
    {"maxIter": 40, "maxDepth": 3, "minInstancesPerNode": 9, "minInfoGain": 0.01,
     "early_stopping_rounds": 4, "stepSize": 0.25}])
def test_trees_are_those_of_spark_ml(prepared, config):
    assert prepared.rows is not None and prepared.train.rdd.getNumPartitions() == 1
    got, want = ML.GBTModel(config).fit_prepared(prepared), by_spark(prepared, ML.GBTModel(config))
    assert got.best_round == want.best_round
    (conditions, values), (conditions_, values_) = lines(got), lines(want)
    assert conditions == conditions_ and values == pytest.approx(values_, rel=1e-9)
    a, b = ([(r.step, r.train_loss, r.val_loss) for r in m.history.collect()] for m in (got, want))
    assert len(a) == len(b) and np.array(a) == pytest.approx(np.array(b), rel=1e-9)
    a, b = ([r.p for r in m.predict(prepared.val).collect()] for m in (got, want))
    assert a == pytest.approx(b, rel=1e-9)
    a, b = (m.model.featureImportances.toArray() for m in (got, want))
    assert a == pytest.approx(b, rel=1e-9)


def test_saved_and_loaded(spark, prepared, tmp_path):
    m = ML.GBTModel({"maxIter": 5, "maxDepth": 3}).fit_prepared(prepared)
    m.save(f"file:{tmp_path}/m")
    back = ML.GBTModel.load(f"file:{tmp_path}/m")
    assert lines(back) == lines(m) and back.model.getMaxDepth() == 3
    assert back.model.numFeatures == 20 and back.model.treeWeights == [1.0, *[0.05] * (m.best_round - 1)]


def test_jobs_of_a_fit_do_not_grow_with_its_rounds(spark, prepared):
    sc = spark.sparkContext

    def jobs(rounds):
        group = f"fit-{rounds}"
        sc.setJobGroup(group, "")
        try:
            ML.GBTModel({"maxIter": rounds, "maxDepth": 4, "early_stopping_rounds": rounds}
                        ).fit_prepared(prepared)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(group))
    few = jobs(2)
    assert 0 < few <= 12 and jobs(40) <= few + 2


def test_other_tables_stay_with_spark_ml(spark, monkeypatch):
    train, val = windows(spark, 60, 3, "train"), windows(spark, 20, 4, "val")
    one_class = train.withColumn("y", F.lit(1))
    assert ML.GBTModel().prepare_trials(one_class, val).rows is None  # weights of 0
    assert ML.GBTModel().prepare_trials(train, val.limit(0)).rows is None
    assert ML.GBTModel().prepare(train, val).rows is None  # a fit, not a search
    monkeypatch.setattr(B, "MAX_ROWS", 59)
    assert ML.GBTModel().prepare_trials(train, val).rows is None


def test_tasks_do_not_need_this_package():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = "import pickle, sys; print(pickle.loads(sys.stdin.buffer.read()).__name__)"
    got = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(ML._boosted({})),
                         capture_output=True, cwd="/", env=env)
    assert got.stdout.strip() == b"run", got.stderr
