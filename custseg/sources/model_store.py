"""Model directory: a fitted scaler plus the labelled training points of the KNN classifier.

Layout (all Parquet, plus one small JSON file):

- ``scaler/``  (feature, mean, scale)
- ``points/``  (id, <features...>, label) scaled training points
- ``meta.json`` {"features": [...], "k": int, "label": "cluster"}
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.prepare import ScalerModel


@dataclass
class KnnModel:
    scaler: ScalerModel
    points: DataFrame          # id, features..., label
    features: list[str]
    k: int
    id_col: str = "id"
    label_col: str = "cluster"


def save_model(model: KnnModel, path: str) -> str:
    spark = model.points.sparkSession
    spark.createDataFrame(model.scaler.to_rows(), "feature string, mean double, scale double") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
    model.points.write.mode("overwrite").parquet(f"{path}/points")
    meta = {"features": model.features, "k": model.k, "id_col": model.id_col, "label": model.label_col}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/meta")
    return path


def load_model(spark: SparkSession, path: str) -> KnnModel:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    rows = spark.read.parquet(f"{path}/scaler").collect()          # one row per feature
    scaler = ScalerModel({r["feature"]: r["mean"] for r in rows}, {r["feature"]: r["scale"] for r in rows})
    points = spark.read.parquet(f"{path}/points")
    return KnnModel(scaler, points, meta["features"], meta["k"], meta["id_col"], meta["label"])
