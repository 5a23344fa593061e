"""The library's fitted transforms as ``pyspark.ml`` stages that can be put in a Pipeline and saved.

* ``Preprocessor`` / ``PreprocessorModel`` (M1, M4): screening, median imputation
  and standardisation into one vector column.
* ``LogTargetRegressor`` / ``LogTargetModel`` (P14): any regressor fitted on
  log1p(max(y, 0)), predictions brought back with expm1.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.exprs import inverse_plain, log_target
from foldwise.operators import prep


class _PreprocessorParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "numeric columns (empty: all numeric ones)", TypeConverters.toListString)
    exclude = Param(Params._dummy(), "exclude", "columns that are not features", TypeConverters.toListString)
    missingThreshold = Param(Params._dummy(), "missingThreshold", "drop columns with a larger share of NULLs", TypeConverters.toFloat)
    outputCol = Param(Params._dummy(), "outputCol", "vector of the kept, imputed, standardised columns", TypeConverters.toString)


class Preprocessor(Estimator, _PreprocessorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits screening, medians and scaler in bounded passes (see ``prep``)."""

    @keyword_only
    def __init__(self, *, inputCols=None, exclude=None, missingThreshold=prep.DEFAULT_MISSING_THRESHOLD, outputCol="features"):
        super().__init__()
        self._setDefault(inputCols=[], exclude=[], missingThreshold=prep.DEFAULT_MISSING_THRESHOLD, outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PreprocessorModel:
        cols = self.getOrDefault(self.inputCols) or None
        fitted = prep.fit(dataset, exclude=self.getOrDefault(self.exclude), features=cols, missing_threshold=self.getOrDefault(self.missingThreshold))
        return self._copyValues(PreprocessorModel(fitted=fitted.to_json()))


class PreprocessorModel(Model, _PreprocessorParams, DefaultParamsReadable, DefaultParamsWritable):
    fitted = Param(Params._dummy(), "fitted", "statistics of the columns as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, fitted=None):
        super().__init__()
        self._setDefault(inputCols=[], exclude=[], missingThreshold=prep.DEFAULT_MISSING_THRESHOLD, outputCol="features")
        if fitted is not None:
            self._set(fitted=fitted)

    @property
    def model(self) -> prep.PrepModel:
        return prep.PrepModel.from_json(self.getOrDefault(self.fitted))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = self.model
        missing = [c for c in model.features if c not in dataset.columns]
        if missing:
            raise ValueError(f"missing fitted features: {sorted(missing)[:10]}")
        values = F.array(*model.columns().values()) if model.features else F.array().cast("array<double>")
        return dataset.withColumn(self.getOrDefault(self.outputCol), array_to_vector(values))


class _InnerWriter(MLWriter):
    """Metadata of a stage and, beside it, the stage that it wraps."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        inner = self.stage.inner
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"inner": f"{type(inner).__module__}.{type(inner).__name__}"})
        inner.write().overwrite().save(f"{path}/inner")


class _InnerReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        module, _, name = meta["inner"].rpartition(".")
        inner_cls = getattr(__import__(module, fromlist=[name]), name)
        stage = self.cls(inner_cls.load(f"{path}/inner"))
        stage._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(stage, meta)
        return stage


class _Wraps(MLReadable, MLWritable):
    def write(self) -> MLWriter:
        return _InnerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _InnerReader(cls)


class LogTargetRegressor(Estimator, _Wraps):
    """Fits ``inner`` on log1p(max(label, 0)); the inner regressor's label and prediction columns are used."""

    def __init__(self, inner=None):
        super().__init__()
        self.inner = inner

    def copy(self, extra=None) -> LogTargetRegressor:
        return LogTargetRegressor(self.inner.copy(extra))

    def _fit(self, dataset: DataFrame) -> LogTargetModel:
        label = self.inner.getLabelCol()
        return LogTargetModel(self.inner.fit(dataset.withColumn(label, log_target(label))))


class LogTargetModel(Model, _Wraps):
    def __init__(self, inner=None):
        super().__init__()
        self.inner = inner

    def copy(self, extra=None) -> LogTargetModel:
        return LogTargetModel(self.inner.copy(extra))

    @property
    def predictionCol(self):
        return self.inner.predictionCol

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.inner.transform(dataset)
        name = self.inner.getPredictionCol()
        return out.withColumn(name, inverse_plain(F.col(name), True))
