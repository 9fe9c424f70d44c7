"""Scaler and nearest-neighbour classifier as spark.ml stages, so that a fitted ``Pipeline`` is one object
that is saved, loaded with ``PipelineModel.load`` and applied to tables and streams.

``Pipeline(stages=[FeatureScaler(...), NeighbourSegmenter(...)]).fit(labelled)`` learns from raw features; the
classifier reads the scaled columns.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols, HasPredictionCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLWritable,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.prepare import scale_data
from ..operators.score import vote


class FeatureScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Mean and population standard deviation of the input columns; a constant column keeps scale 1."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FeatureScalerModel:
        names = self.getInputCols()
        _, fitted = scale_data(dataset, names)
        return FeatureScalerModel(inputCols=names, outputCols=self.getOutputCols(),
                                  means=[float(fitted.mean[f]) for f in names], scales=[float(fitted.scale[f]) for f in names])


class FeatureScalerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Adds (x - mean) / scale of every input column as an output column; null stays null."""

    means = Param(Params._dummy(), "means", "mean of each input column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "scale of each input column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, means=None, scales=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.means), self.getOrDefault(self.scales))
        return dataset.select("*", *[((F.col(f).cast("double") - m) / s).alias(out) for f, out, m, s in columns])


class _NeighbourParams(HasInputCols, HasLabelCol, HasPredictionCol):
    idCol = Param(Params._dummy(), "idCol", "id of a labelled row; breaks ties of distance", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "number of neighbours", TypeConverters.toInt)
    maxPoints = Param(Params._dummy(), "maxPoints", "labelled rows that are broadcast at most", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(k=5, maxPoints=C.KNN_MAX_POINTS, idCol="id", labelCol="cluster", predictionCol="segment")


class NeighbourSegmenter(Estimator, _NeighbourParams, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the labelled rows (id, input columns, label) of the training table."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, predictionCol=None, idCol=None, k=None, maxPoints=None):
        super().__init__()
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> NeighbourSegmenterModel:
        columns = [self.getOrDefault(self.idCol), *self.getInputCols(), self.getLabelCol()]
        model = NeighbourSegmenterModel()
        self._copyValues(model)
        model.points = dataset.select(*columns).dropna(subset=columns[1:])
        return model


class _PointsWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.points.write.parquet(f"{path}/points")


class _PointsReader(DefaultParamsReader):
    def load(self, path: str) -> NeighbourSegmenterModel:
        model = super().load(path)
        model.points = self.sparkSession.read.parquet(f"{path}/points")
        return model


class NeighbourSegmenterModel(Model, _NeighbourParams, MLReadable, MLWritable):
    """Adds the class that the k nearest labelled rows vote for (weights 1 / distance); null where an input is
    null. Tables meet all labelled rows; see ``operators.score`` for streams and large models."""

    points: DataFrame | None = None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getInputCols()
        return vote(dataset, [F.col(f).cast("double") for f in names], self.points, names, self.getOrDefault(self.k),
                    self.getOrDefault(self.idCol), self.getLabelCol(), self.getPredictionCol(),
                    self.getOrDefault(self.maxPoints))

    def copy(self, extra=None) -> NeighbourSegmenterModel:
        other = super().copy(extra)
        other.points = self.points
        return other

    def write(self) -> _PointsWriter:
        return _PointsWriter(self)

    @classmethod
    def read(cls) -> _PointsReader:
        return _PointsReader(cls)
