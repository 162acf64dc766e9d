"""Features and detectors as ``pyspark.ml`` stages, so that a Pipeline fits, saves and loads them."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame

from emberlog.operators.detector import AnomalyDetector
from emberlog.operators.features import FeatureModel, fit_features


class _Writer(MLWriter):
    def __init__(self, instance: _FittedStage):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.held.save(f"{path}/held")


class _Reader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind(self.kind.holds.load(self.sparkSession, f"{path}/held"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class _WithRowId(Params):
    rowId = Param(Params._dummy(), "rowId", "column that names a row", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(rowId="event_id")


class _FittedStage(Model, _WithRowId, MLWritable, MLReadable):
    """A fitted object that can ``save`` and ``load`` itself, held in a stage."""

    holds: type

    def __init__(self, held=None):
        super().__init__()
        self.held = held

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class FittedFeatures(_FittedStage):
    """Raw logs become scaled features, with what the training rows taught."""

    holds = FeatureModel

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.held.transform(dataset, [self.getOrDefault(self.rowId)])


class LogFeatures(Estimator, _WithRowId, DefaultParamsWritable, DefaultParamsReadable):
    """Learns vocabulary, node baseline and scaling from raw logs."""

    def _fit(self, dataset: DataFrame) -> FittedFeatures:
        return self._copyValues(FittedFeatures(fit_features(dataset)))


class FittedDetector(_FittedStage):
    """Adds ``anomaly_score`` and ``is_predicted_anomaly``."""

    holds = AnomalyDetector

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.held.predict(dataset, self.getOrDefault(self.rowId))


class Detector(Estimator, _WithRowId, DefaultParamsWritable, DefaultParamsReadable):
    """One of the three detectors over ``inputCols``; without them, over all columns that are not identification."""

    modelType = Param(Params._dummy(), "modelType", "isolation_forest, lof or ocsvm", TypeConverters.toString)
    contamination = Param(Params._dummy(), "contamination", "share of training rows beyond the threshold", TypeConverters.toFloat)
    inputCols = Param(Params._dummy(), "inputCols", "columns the detector reads", TypeConverters.toListString)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, modelType: str = "isolation_forest", contamination: float = 0.02, inputCols: list[str] | None = None, seed: int = 42):
        super().__init__()
        self._setDefault(modelType="isolation_forest", contamination=0.02, inputCols=[], seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FittedDetector:
        row_id = self.getOrDefault(self.rowId)
        columns = self.getOrDefault(self.inputCols) or [c for c in dataset.columns if c not in ("timestamp", "node", "is_anomaly", row_id)]
        detector = AnomalyDetector(self.getOrDefault(self.modelType), self.getOrDefault(self.contamination), self.getOrDefault(self.seed))
        return self._copyValues(FittedDetector(detector.fit(dataset, columns, row_id)))
