"""The panel's way from bars to P(up) as Spark ML stages.

``PanelFeatures -> ChronoSplit -> PanelScaler -> SlidingWindows -> GBTDirection`` (or
``MLPDirection``) form one ``Pipeline``: fitting learns the scaling from the train
split and the classifier from its windows, and the ``PipelineModel`` takes bars
to P(up). Every stage has typed params (an unknown one raises), and saves and
loads with the pipeline, the scaling as a table, the classifiers as Spark ML
models.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barpanel.constants import DEFAULT_WINDOW
from barpanel.operators import features as FT
from barpanel.operators import models as ML
from barpanel.plans.layout import AutoLayout, SeriesLayout, materialize, resolve


class _Series(Params):
    """Params that name the series: its key, its time axis, and the rows that a
    window may hold before a series is cut into blocks."""

    key = Param(Params._dummy(), "key", "column of the series' name", TypeConverters.toString)
    order = Param(Params._dummy(), "order", "column of the time axis", TypeConverters.toString)
    blockRows = Param(Params._dummy(), "blockRows", "rows of a series in one window at most",
                      TypeConverters.toInt)

    def _defaults(self):
        self._setDefault(key="ticker", order="date", blockRows=1 << 20)

    def _layout(self, df: DataFrame) -> SeriesLayout:
        """Blocked if an earlier stage has cut the series, else by their size."""
        key, order = self.getOrDefault(self.key), (self.getOrDefault(self.order),)
        if "_blk" in df.columns:
            return SeriesLayout(key=key, order=order, block_rows=self.getOrDefault(self.blockRows))
        return SeriesLayout(key=key, order=order)


class PanelFeatures(Transformer, _Series, DefaultParamsReadable, DefaultParamsWritable):
    """the complete feature rows of the bars."""

    @keyword_only
    def __init__(self, *, key="ticker", order="date", blockRows=1 << 20):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        bars = materialize(dataset)  # looked at for its size, then read
        lay = resolve(AutoLayout(key=self.getOrDefault(self.key),
                                 order=(self.getOrDefault(self.order),),
                                 block_rows=self.getOrDefault(self.blockRows)), bars)
        return FT.feature_frame(bars, lay)


class ChronoSplit(Transformer, _Series, DefaultParamsReadable, DefaultParamsWritable):
    """``split`` by position, with the positions that windows need."""

    @keyword_only
    def __init__(self, *, key="ticker", order="date", blockRows=1 << 20):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return materialize(FT.chrono_split(dataset, self._layout(dataset), keep_pos=True))


class SlidingWindows(Transformer, _Series, DefaultParamsReadable, DefaultParamsWritable):
    """Windows of scaled rows with their targets."""

    window = Param(Params._dummy(), "window", "rows in a window", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, key="ticker", order="date", blockRows=1 << 20, window=DEFAULT_WINDOW):
        super().__init__()
        self._defaults()
        self._setDefault(window=DEFAULT_WINDOW)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return FT.sliding_sequences(dataset, self._layout(dataset), self.getOrDefault(self.window))


# -- stages that learn -----------------------------------------------------------

class _Writer(MLWriter):
    """Params as Spark ML's own stages save them, and the stage's data beside."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         {"data": self.instance._describe()})
        self.instance._save_data(f"{path}/data")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage._load_data(self.sparkSession, f"{path}/data", metadata["data"])
        return stage


class _Stored(MLWritable, MLReadable):
    """Saving and loading of a fitted stage."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def _describe(self) -> dict:
        return {}


class PanelScaler(Estimator, _Series, DefaultParamsReadable, DefaultParamsWritable):
    """the least and greatest value of each feature of each series, over the
    train split."""

    @keyword_only
    def __init__(self, *, key="ticker", order="date", blockRows=1 << 20):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PanelScalerModel":
        params = materialize(FT.fit_minmax(dataset, self.getOrDefault(self.key)))
        return self._copyValues(PanelScalerModel(params))


class PanelScalerModel(_Stored, Model, _Series):
    """scales with the stored values; series without any give no rows."""

    def __init__(self, params: DataFrame | None = None):
        super().__init__()
        self._defaults()
        self.bounds = params

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return FT.apply_minmax(dataset, self.bounds, self.getOrDefault(self.key))

    def _save_data(self, path: str) -> None:
        self.bounds.write.parquet(path)

    def _load_data(self, spark: SparkSession, path: str, _: dict) -> None:
        self.bounds = spark.read.parquet(path)


class _Direction(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """A classifier of the next day's direction, by its name in the registry.
    ``config`` (JSON) overrides the model's defaults; a name that it does not
    know raises."""

    config = Param(Params._dummy(), "config", "the model's settings, as JSON", TypeConverters.toString)
    kind = ""

    @keyword_only
    def __init__(self, *, config="{}"):
        super().__init__()
        self._setDefault(config="{}")
        self._set(**self._input_kwargs)
        ML.build_model(self.kind, json.loads(self.getOrDefault(self.config)))  # checks the names

    def _fit(self, dataset: DataFrame) -> "DirectionModel":
        windows = materialize(dataset)  # train and val are read apart
        model = ML.build_model(self.kind, json.loads(self.getOrDefault(self.config)))
        model.fit(windows.filter(F.col("split") == "train"), windows.filter(F.col("split") == "val"))
        return DirectionModel(model)


class GBTDirection(_Direction):
    kind = "gbt"


class MLPDirection(_Direction):
    kind = "mlp"


class DirectionModel(_Stored, Model):
    """M3: label and P(up) for every window."""

    def __init__(self, model: ML.PanelModel | None = None):
        super().__init__()
        self.model = model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model.predict(dataset)

    def _describe(self) -> dict:
        return {"kind": self.model.kind, "config": self.model.config,
                "best_round": self.model.best_round}

    def _save_data(self, path: str) -> None:
        self.model.save(path)

    def _load_data(self, spark: SparkSession, path: str, data: dict) -> None:
        self.model = ML.MODEL_REGISTRY[data["kind"]].load(path, data["config"])
        self.model.best_round = data["best_round"]


def direction_pipeline(kind: str = "gbt", config: dict | None = None, window: int = DEFAULT_WINDOW,
                       block_rows: int = 1 << 20):
    """Bars to P(up) as one Spark ML pipeline."""
    from pyspark.ml import Pipeline
    classifiers = {"gbt": GBTDirection, "mlp": MLPDirection}
    if kind not in classifiers:
        raise ValueError(f"unknown model {kind!r}; known: {sorted(classifiers)}")
    return Pipeline(stages=[
        PanelFeatures(blockRows=block_rows), ChronoSplit(blockRows=block_rows),
        PanelScaler(blockRows=block_rows), SlidingWindows(blockRows=block_rows, window=window),
        classifiers[kind](config=json.dumps(config or {}))])
