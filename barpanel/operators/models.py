"""Direction classifiers on window tensors with Spark ML.

The reference trains boosted trees on flattened windows and three torch
networks on the 3-D tensors. Here the tree model is Spark ML's
``GBTClassifier`` and the network family is re-aimed to
``MultilayerPerceptronClassifier`` on the same flattened windows; both fit
distributed over the partitions of the (cached) window table. The recurrent /
convolutional / attention networks themselves are not built (see README).
"""

from __future__ import annotations

import json
import math
import re
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkContext, cloudpickle
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier,
                                       MultilayerPerceptronClassificationModel,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barpanel.constants import FEATURE_COLS, IMPROVE_EPS, PROBA_THRESHOLD
from barpanel.operators import boosting as B
from barpanel.operators import metrics as M
from barpanel.session import ensure_checkpoint_dir
from barpanel.sources.store import PanelStore

#: Goes to the tasks with the function: no panel operator asks for this package there.
cloudpickle.register_pickle_by_value(B)

# --- fixed values: model defaults (merged with a user config) --------------
GBT_DEFAULTS = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
                "featureSubsetStrategy": "0.8", "minInstancesPerNode": 1, "minInfoGain": 0.0,
                "seed": 42, "early_stopping_rounds": 30}
MLP_DEFAULTS = {"hidden": [64], "epochs": 50, "patience": 10, "steps_per_epoch": 5, "seed": 42}
# -----------------------------------------------------------------------------


class NotTrainedError(RuntimeError):
    pass


def with_vectors(seqs: DataFrame, seq: str = "seq", out: str = "features") -> DataFrame:
    """P6 for ML: flattened window as an ML vector (oldest day first)."""
    flat = F.transform(F.flatten(F.col(seq)), lambda v: v.cast("double"))
    return seqs.withColumn(out, array_to_vector(flat)).withColumn("label", F.col("y").cast("double"))


class Prepared:
    """Persisted train and val vectors; whoever prepared them releases them,
    after the last fit. They are checkpointed first: a fit runs thousands of small
    jobs, and every task of them would carry the plan that made the vectors."""

    def __init__(self, train: DataFrame, val: DataFrame | None):
        ensure_checkpoint_dir(train.sparkSession)
        self.train = train.checkpoint().persist()
        self.val = None if val is None else val.checkpoint().persist()
        self.n_features = len(self.train.select("features").first()[0])

    #: Train and val rows in one partition, if they are few; see :meth:`gather`.
    rows: DataFrame | None = None

    def gather(self) -> "Prepared":
        """Rows of a small table also in one partition, the train rows first, for
        fits in one task (:mod:`barpanel.operators.boosting`)."""
        def few(d):
            n, least, known = d.agg(F.count(F.lit(1)), F.min("weight"), F.count("weight")).first()
            return 0 < n <= B.MAX_ROWS and known == n and least > 0
        if self.val is not None and few(self.train) and few(self.val):
            own = [d.select(vector_to_array("features").alias("x"), "label", "weight",
                            F.lit(k).alias("val")) for k, d in enumerate((self.train, self.val))]
            self.rows = own[0].unionByName(own[1]).coalesce(1).checkpoint()
        return self

    def release(self) -> None:
        for d in (self.train, self.val):
            if d is not None:
                d.unpersist()


class PanelModel:
    """M10 contract: defaults merged with the user config; ``fit`` on the
    train windows (val only for early stopping); ``predict`` before ``fit``
    raises; ``save`` / ``load`` round trip."""

    kind = "base"
    defaults: dict = {}

    def __init__(self, config: dict | None = None):
        unknown = sorted(set(config or {}) - set(self.defaults))
        if unknown:
            raise ValueError(f"unknown settings {unknown}; known: {sorted(self.defaults)}")
        self.config = {**self.defaults, **(config or {})}
        self.model = None
        self.history = None
        self.best_round = None

    # -- to override -------------------------------------------------------
    def prepare(self, train: DataFrame, val: DataFrame | None = None) -> "Prepared":
        """Vectors of the windows, persisted, for one fit or many."""
        return Prepared(with_vectors(train), None if val is None else with_vectors(val))

    def prepare_trials(self, train: DataFrame, val: DataFrame) -> "Prepared":
        """As :meth:`prepare`, for the trials of a search."""
        return self.prepare(train, val)

    def fit_prepared(self, data: "Prepared") -> "PanelModel":
        raise NotImplementedError

    # -- common ------------------------------------------------------------
    def fit(self, train: DataFrame, val: DataFrame | None = None) -> "PanelModel":
        data = self.prepare(train, val)
        try:
            return self.fit_prepared(data)
        finally:
            data.release()

    def _check(self):
        if self.model is None:
            raise NotTrainedError("the model is not trained yet")

    def predict(self, seqs: DataFrame) -> DataFrame:
        """(ticker, split, date, y, p, pred): P(up) and the hard label."""
        self._check()
        out = self.model.transform(seqs if "features" in seqs.columns else with_vectors(seqs))
        p = vector_to_array("probability")[1]
        return out.select("ticker", "split", "date", F.col("y").cast("int").alias("y"),
                          p.alias("p"), self._label(p, out).alias("pred"))

    def _label(self, p, out):
        return (p >= F.lit(PROBA_THRESHOLD)).cast("int")

    def evaluate(self, seqs: DataFrame, by=("ticker", "split")) -> DataFrame:
        return M.evaluate(self.predict(seqs), by=by)

    def save(self, path: str) -> str:
        self._check()
        self.model.write().overwrite().save(path)
        return path

    @classmethod
    def load(cls, path: str, config: dict | None = None) -> "PanelModel":
        inst = cls(config)
        inst.model = cls._model_class().load(path)
        return inst


class GBTModel(PanelModel):
    """M1-M4: boosted trees with class weights, row / feature subsampling and
    a validation-chosen number of trees (patience ``early_stopping_rounds``)."""

    kind = "gbt"
    defaults = GBT_DEFAULTS

    @staticmethod
    def _model_class():
        return GBTClassificationModel

    def _estimator(self, n_features, train, max_iter=None):
        c = self.config
        return GBTClassifier(maxIter=max_iter or c["maxIter"], maxDepth=c["maxDepth"],
                             stepSize=c["stepSize"], subsamplingRate=c["subsamplingRate"],
                             featureSubsetStrategy=str(c["featureSubsetStrategy"]),
                             minInstancesPerNode=c["minInstancesPerNode"],
                             minInfoGain=c["minInfoGain"], weightCol="weight", seed=c["seed"])

    def _label(self, p, out):
        return F.col("prediction").cast("int")

    def prepare(self, train: DataFrame, val: DataFrame | None = None, by=()) -> Prepared:
        """With class weights, over all rows or per group ``by``."""
        tr = train if by else train.select("*", F.lit(1).alias("_all"))
        bal = M.class_balance(tr, by=by or ("_all",))
        return Prepared(with_vectors(M.with_class_weight(tr, bal, by=by or ("_all",))),
                        None if val is None else
                        with_vectors(val).withColumn("weight", F.lit(1.0)))

    def prepare_trials(self, train: DataFrame, val: DataFrame) -> Prepared:
        return self.prepare(train, val).gather()

    def fit_prepared(self, data: Prepared) -> "GBTModel":
        """M1/M2. With val vectors the trees stop once the validation log-loss
        has had no strict minimum for ``early_stopping_rounds`` rounds, and the
        trees up to that minimum stay. Spark ML grows a whole ensemble at
        once, so ensembles of growing size are fitted until one holds its
        minimum and the patience (the same seed gives the same first trees), and
        its first trees are kept. Rows that were gathered are fitted in one task, as
        Spark ML would fit them, but round by round."""
        tv, vv = data.train, data.val
        if data.rows is not None and re.fullmatch(r"0?\.\d*[1-9]\d*|1\.0+",
                                                  str(self.config["featureSubsetStrategy"])):
            return self._fit_in_one_task(data)
        most, patience = self.config["maxIter"], self.config["early_stopping_rounds"]
        if vv is None:
            self.best_round = most
            self.model = self._estimator(data.n_features, tv).fit(tv)
            return self
        rounds = min(most, 2 * patience)
        while True:
            model = self._estimator(data.n_features, tv, rounds).fit(tv)
            # Spark's boosting loss is twice the binary log-loss
            vl = [x / 2 for x in model.evaluateEachIteration(vv)]
            self.best_round, stop = first_minimum(vl, patience)
            if stop < rounds or rounds == most:
                break
            rounds = min(most, 3 * rounds)
        tl = [x / 2 for x in model.evaluateEachIteration(tv)]
        self.history = tv.sparkSession.createDataFrame(
            [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(tl, vl)) if i < stop],
            "step int, train_loss double, val_loss double")
        self.model = model if self.best_round == rounds else first_trees(model, self.best_round)
        return self

    def _fit_in_one_task(self, data: Prepared) -> "GBTModel":
        spark = data.rows.sparkSession
        est = self._estimator(data.n_features, data.train)
        est._transfer_params_to_java()  # checks their ranges
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fit-{uuid.uuid4().hex}"
        Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        try:
            data.rows.mapInArrow(_boosted(self.config), ENSEMBLE).write.parquet(f"{path}/data")
            tl, vl = (spark.read.schema(ENSEMBLE).parquet(f"{path}/data")
                      .filter("train_loss IS NOT NULL").select("train_loss", "val_loss").first())
            self.best_round, stop = first_minimum(vl, self.config["early_stopping_rounds"])
            for name, content in _described(est, data.n_features, self.best_round, spark.version):
                out = fs.create(Path(f"{path}/{name}"))
                try:
                    out.write(bytearray(content))
                finally:
                    out.close()
            self.model = GBTClassificationModel.load(path)
        finally:
            fs.delete(Path(path), True)
        losses = [(k, *both) for k, both in enumerate(zip(tl, vl), 1)]
        self.history = spark.createDataFrame(
            losses[:stop], "step int, train_loss double, val_loss double")
        return self

    def importances(self, window: int, names=FEATURE_COLS) -> DataFrame:
        """M4: importance per (lag, feature) of the flattened window."""
        self._check()
        k = len(names)
        imp = [0.0] * (window * k)
        if self.model.totalNumNodes > self.model.getNumTrees:  # a tree splits
            found = self.model.featureImportances.toArray()
            imp[:len(found)] = found
        rows = [(window - i // k, names[i % k], float(v)) for i, v in enumerate(imp)]
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame(rows, "lag int, feature string, importance double")


#: Nodes of the trees kept, as a saved model has them; the first node also has the
#: losses of all rounds run.
ENSEMBLE = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, "
            "impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, "
            "rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: "
            "array<double>, numCategories: int>>, train_loss array<double>, val_loss array<double>")


def _boosted(config: dict):
    """Task function: one ensemble from all rows of the (only) partition."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        val = t.column("val").to_numpy()
        order = np.argsort(val, kind="stable")
        y, w = (t.column(c).to_numpy()[order] for c in ("label", "weight"))
        x = t.column("x").combine_chunks().flatten().to_numpy().reshape(len(y), -1)[order]
        g, trees, losses, _ = B.boost(x, y, w, len(y) - int(val.sum()), config)
        rows = [(k, *r) for k, tree in enumerate(trees) for r in B.node_rows(g, tree)]
        if not rows:
            raise ValueError("no round has a minimum of the validation loss")
        tree, id_, p, impurity, stats, n, gain, left, right, feature, threshold = zip(*rows)
        d, i = pa.float64(), pa.int32()
        many = pa.list_(d)

        def struct(**of):
            return pa.StructArray.from_arrays(list(of.values()), list(of))
        split = struct(featureIndex=pa.array(feature, i), leftCategoriesOrThreshold=pa.array(
            [[] if v is None else [v] for v in threshold], many), numCategories=pa.array([-1] * len(rows), i))
        node = struct(id=pa.array(id_, i), prediction=pa.array(p, d), impurity=pa.array(impurity, d),
                      impurityStats=pa.array(stats, many), rawCount=pa.array(n, pa.int64()),
                      gain=pa.array(gain, d), leftChild=pa.array(left, i),
                      rightChild=pa.array(right, i), split=split)
        rest = [None] * (len(rows) - 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree, i), node, *(pa.array([list(c), *rest], many) for c in zip(*losses))],
            names=["treeID", "nodeData", "train_loss", "val_loss"])
    return run


def _described(est: GBTClassifier, n_features: int, k: int, version: str) -> list[tuple[str, bytes]]:
    """What a saved ``GBTClassificationModel`` of ``k`` trees has besides its nodes."""
    def said(kind, uid, names=None, **more):
        params = ({p.name: v for p, v in m.items() if names is None or p.name in names}
                  for m in (est._paramMap, est._defaultParamMap))
        return json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000),
                           "sparkVersion": version, "uid": uid,
                           **dict(zip(("paramMap", "defaultParamMap"), params)), **more})
    of_tree = {"cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol",
               "maxBins", "maxDepth", "maxMemoryInMB", "minInfoGain", "minInstancesPerNode",
               "minWeightFractionPerNode", "predictionCol", "seed", "weightCol"}
    trees = pa.table({
        "_1": pa.array(range(k), pa.int32()),
        "_2": [said("regression.DecisionTreeRegressionModel", f"{est.uid}-{i}", of_tree)
               for i in range(k)],
        "_3": [1.0 if i == 0 else float(est.getStepSize()) for i in range(k)]})
    pq.write_table(trees, found := pa.BufferOutputStream())
    whole = said("classification.GBTClassificationModel", est.uid, numFeatures=n_features, numTrees=k)
    return [("metadata/part-00000.txt", whole.encode()),
            ("treesMetadata/part-00000.parquet", found.getvalue().to_pybytes())]


def first_trees(model: GBTClassificationModel, k: int) -> GBTClassificationModel:
    """The ensemble of the first ``k`` trees, by the class's public constructor (it
    leaves the number of features open, which scoring does not need)."""
    sc = SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml
    trees = sc._gateway.new_array(ml.regression.DecisionTreeRegressionModel, k)
    weights = sc._gateway.new_array(sc._jvm.double, k)
    from_trees, from_weights = model._java_obj.trees(), model._java_obj.treeWeights()
    for i in range(k):
        trees[i], weights[i] = from_trees[i], from_weights[i]
    return model._copyValues(GBTClassificationModel(
        ml.classification.GBTClassificationModel(model.uid, trees, weights)))


def first_minimum(losses, patience: int) -> tuple[int, int]:
    """(round of the strict minimum, last round run), counted from 1, when
    boosting stops after ``patience`` rounds without a new minimum."""
    best, at = math.inf, 0
    for i, x in enumerate(losses, 1):
        if x < best:
            best, at = x, i
        elif i - at >= patience:
            return at, i
    return at, len(losses)


class MLPModel(PanelModel):
    """M5: feed-forward network on the flattened window (the neural family).

    An epoch is ``steps_per_epoch`` quasi-Newton steps from the weights so far.
    With ``val`` the replayed rule of K3 (its improvement margin and
    ``patience``) ends the training, and the best epoch's weights stay;
    ``history`` holds both losses of every epoch."""

    kind = "mlp"
    defaults = MLP_DEFAULTS

    @staticmethod
    def _model_class():
        return MultilayerPerceptronClassificationModel

    def prepare(self, train: DataFrame, val: DataFrame | None = None) -> Prepared:
        # Spark averages the gradient over blocks of a partition, so rows of
        # small partitions would weigh more: deal them out evenly
        parts = max(1, min(train.rdd.getNumPartitions(), train.count() // 2048))
        return Prepared(with_vectors(train).repartition(parts),
                        None if val is None else with_vectors(val))

    def fit_prepared(self, data: Prepared) -> "MLPModel":
        c, weights, tv, vv = self.config, None, data.train, data.val
        layers = [data.n_features, *c["hidden"], 2]
        rows, best, wait = [], (math.inf, 0, None), 0
        for epoch in range(1, c["epochs"] + 1):
            e = MultilayerPerceptronClassifier(layers=layers, maxIter=c["steps_per_epoch"],
                                               seed=c["seed"])
            if weights is not None:
                e = e.setInitialWeights(weights)
            self.model = e.fit(tv)
            weights = self.model.weights
            tl, vl = (None if d is None else self._loss(d) for d in (tv, vv))
            rows.append((epoch, tl, vl))
            if vv is None:
                continue
            if vl < best[0] - IMPROVE_EPS:
                best, wait = (vl, epoch, self.model), 0
            else:
                wait += 1
                if wait >= c["patience"]:
                    break
        if vv is not None and best[2] is not None:
            self.model = best[2]
        self.best_round = best[1] or len(rows)
        self.history = tv.sparkSession.createDataFrame(
            rows, "step int, train_loss double, val_loss double")
        return self

    def _loss(self, vectors: DataFrame) -> float:
        p = vector_to_array("probability")[1]
        return float(self.model.transform(vectors).select(p.alias("p"), "y")
                     .agg(M.log_loss()).first()[0] or 0.0)


MODEL_REGISTRY = {"gbt": GBTModel, "mlp": MLPModel}


def build_model(name: str, config: dict | None = None) -> PanelModel:
    """Name -> model with defaults merged; unknown name -> error."""
    if name not in MODEL_REGISTRY:
        raise ValueError(f"unknown model {name!r}; known: {sorted(MODEL_REGISTRY)}")
    return MODEL_REGISTRY[name](config)


def train_per_ticker(stored: DataFrame, name: str, tickers, config: dict | None = None,
                     threads: int = 8, path: str | None = None) -> dict:
    """M6: one model per requested ticker, fitted as concurrent Spark jobs from
    a small thread pool. ``stored`` is a table partitioned by (ticker, split),
    so a fit reads its own partitions only. A ticker without windows raises.
    With ``path`` each model and its predictions are stored as soon as it is
    fitted (see :func:`predictions_of`): what is done stays when the driver dies,
    and the plan of an evaluation does not grow with the tickers. Tickers that are
    stored there already are loaded, not fitted."""
    from urllib.parse import quote
    done = PanelStore(stored.sparkSession, f"{path}/predictions") if path else None
    have = {k[0] for k in done.live()} if path else set()

    def one(t):
        own = f"{path}/models/{quote(t, safe='')}"
        if t in have:
            return t, MODEL_REGISTRY[name].load(own, config)
        s = stored.filter(F.col("ticker") == t)
        tr, va = s.filter(F.col("split") == "train"), s.filter(F.col("split") == "val")
        if tr.isEmpty():
            raise ValueError(f"no windows for {t!r}")
        m = build_model(name, config).fit(tr, va)
        if path:
            m.save(own)
            done.write(m.predict(s).withColumn("best_round", F.lit(m.best_round)))
        return t, m

    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(tickers)))) as ex:
        return dict(ex.map(one, tickers))


def predictions_of(spark, path: str) -> DataFrame:
    """The stored predictions of every ticker's model: (ticker, split, date, y, p,
    pred, best_round)."""
    return PanelStore(spark, f"{path}/predictions").read()


RUN_SCHEMA = "run string, kind string, key string, step int, value double, text string"


def run_log_rows(run: str, kind: str, params: dict, metrics: DataFrame | None = None,
                 history: DataFrame | None = None, spark=None,
                 counts: DataFrame | None = None, importances: DataFrame | None = None) -> DataFrame:
    """M8/M9: long rows of one run. Numbers stand in ``value``, everything else
    (strings, lists, flags) in ``text``; nothing is dropped. ``counts``: rows
    per (ticker, split)."""
    rows = []
    for k, v in params.items():
        number = isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v)
        text = None if number else v if isinstance(v, str) else json.dumps(v)
        rows.append((run, kind, f"param.{k}", None, float(v) if number else None, text))
    df = spark.createDataFrame(rows, RUN_SCHEMA)

    def add(key, value, step=None, of=None):
        return df.unionByName(of.select(
            F.lit(run).alias("run"), F.lit(kind).alias("kind"), key.alias("key"),
            (F.lit(None) if step is None else F.col(step)).cast("int").alias("step"),
            value.cast("double").alias("value"), F.lit(None).cast("string").alias("text")))
    if counts is not None:
        df = add(F.concat(F.lit("count."), "ticker", F.lit(".n_"), "split"), F.col("n"), of=counts)
    if metrics is not None:
        df = add(F.concat(F.lit("metric."), "ticker", F.lit("."), "key"), F.col("value"),
                 of=M.metrics_long(metrics))
    if importances is not None:
        df = add(F.concat(F.lit("importance."), "feature", F.lit(".lag"), F.col("lag")),
                 F.col("importance"), of=importances)
    if history is not None:
        for c in ("train_loss", "val_loss"):
            df = add(F.lit(c), F.col(c), "step", history)
    return df


def append_runs(rows: DataFrame, path: str, run_id: str | None = None) -> str:
    """M8: adds one run to the run table, exactly once. A run is what ``run_id``
    names: writing it again (a retry, a writer thought dead) replaces it, whole,
    and runs written at the same time do not disturb each other. Without a
    ``run_id`` the call is a run of its own. Returns the id."""
    run_id = run_id or uuid.uuid4().hex
    PanelStore(rows.sparkSession, path, ("run_id",)).write(
        rows.withColumn("run_id", F.lit(run_id)))
    return run_id


def read_runs(spark, path: str, run_id: str | None = None) -> DataFrame:
    """M8: all runs, or one; ``RUN_SCHEMA`` and ``run_id``."""
    df = PanelStore(spark, path, ("run_id",)).read(run_id=run_id)
    return spark.createDataFrame([], f"{RUN_SCHEMA}, run_id string") if df is None else df
