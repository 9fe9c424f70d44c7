"""Scoring with a saved scaler + KNN model: raw R/F/M rows in, segment out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..sources.model_store import KnnModel
from . import classify as CL
from .knn_join import knn_join
from .prepare import scaled


def score(df: DataFrame, model: KnnModel, out_col: str = "segment", max_points: int = C.KNN_MAX_POINTS) -> DataFrame:
    """``df`` (a table or a stream) with ``out_col``: the raw features are scaled with the stored mean and
    scale and the nearest stored points vote. All columns of ``df`` stay as they are; rows need no id. A
    row with a null feature gets a null segment.

    Up to ``max_points`` stored points are broadcast and vote inside a column expression. A table is joined
    with more points exactly; a stream, which has no such join, is scored by ``max_points`` of them.
    """
    features = [scaled(f, model.scaler) for f in model.features]
    return vote(df, features, model.points, model.features, model.k, model.id_col, model.label_col, out_col, max_points)


def vote(df: DataFrame, columns: list[Column], points: DataFrame, features: list[str], k: int, id_col: str, label_col: str,
         out_col: str, max_points: int = C.KNN_MAX_POINTS) -> DataFrame:
    """``df`` with the class that the k nearest ``points`` to the values of ``columns`` vote for; see ``score``."""
    if df.isStreaming or points.count() <= max_points:
        known = CL.labelled_points(points, features, id_col, label_col, max_points=max_points)
        return df.withColumn(out_col, CL.votes(known, columns, [k])[0])
    ready = df.withColumn("_x", F.array(*columns))
    points = points.withColumn("_x", F.array(*[F.col(f).cast("double") for f in features]))
    near = knn_join(ready, points, "_x", k, id_col, label_col, out_col="_near")
    return near.withColumn(out_col, CL.neighbour_votes("_near", [k])[0]).drop("_near", "_x")
