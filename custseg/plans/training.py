"""RFM features -> outlier removal, scaling, K-Means with quality metrics, ordered segments,
KNN with cross-validated k, evaluation tables and a saved scoring model.

Small results (curves, metrics, centres) are DataFrames of k rows; a ``run_metrics``
table (run_id, kind, name, step, value) collects the scalars.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import classify as CL
from ..operators import cluster as CU
from ..operators import prepare
from ..operators import summaries as SU
from ..operators.silhouette import silhouette
from ..session import materialise
from ..sources.model_store import KnnModel, save_model
from ..sources.tables import write_parquet


@dataclass
class TrainResult:
    labelled: DataFrame                 # unscaled features + ordered cluster
    scaled: DataFrame                   # scaled features + ordered cluster
    sse: DataFrame | None               # (k, sse, silhouette_sq)
    knn_scores: DataFrame               # (k, accuracy)
    confusion: DataFrame
    report: DataFrame
    model: KnnModel
    centres: DataFrame | None = None    # (cluster, feature, value) of the K-Means model
    stages: DataFrame | None = None     # (stage, feature, box numbers) of each stage
    metrics: dict = field(default_factory=dict)
    params: dict = field(default_factory=dict)


def box_tables(stage: str, df: DataFrame, features: list[str]) -> DataFrame:
    """(stage, feature, n, quartiles, whiskers, outliers): the numbers of a stage's box plots."""
    out = None
    for f in features:
        one = SU.box_stats(df, f).select(F.lit(stage).alias("stage"), F.lit(f).alias("feature"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def train(rfm: DataFrame, features=tuple(C.RFM_FEATURES), k: int = C.KMEANS_K,
          outlier_mode: str = "last", order_mode: str = "monetary", sweep=C.KMEANS_SWEEP,
          id_col: str = "customer_id", max_points: int = C.KNN_MAX_POINTS,
          tolerance: float = C.SILHOUETTE_TOLERANCE) -> TrainResult:
    """Every intermediate table is written once to the shared folder and read back by what follows.
    The classifier learns from all labelled rows; up to ``max_points`` are broadcast, more are joined.
    Euclidean silhouettes are certified to ``tolerance``."""
    feats = list(features)
    # counted by the jobs that write the two tables
    seen, left = Observation(), Observation()
    rfm = materialise(rfm.observe(seen, F.count(F.lit(1)).alias("rows")), "train_rfm")
    kept = materialise(prepare.remove_outliers(rfm, feats, mode=outlier_mode).observe(left, F.count(F.lit(1)).alias("rows")),
                       "train_kept")
    scaled, scaler = prepare.scale_data(kept, feats)
    scaled = materialise(scaled, "train_scaled")
    sse = CU.kmeans_sweep(scaled, feats, sweep, tolerance=tolerance) if sweep else None
    kmodel, clustered = CU.kmeans_fit(scaled, feats, k=k)
    metrics = {"inertia": kmodel.sse}
    metrics["davies_bouldin"] = CU.davies_bouldin(clustered, feats).first()[0]
    certified = silhouette(clustered, feats, tolerance=tolerance).first()
    metrics["silhouette"], metrics["silhouette_error"] = certified["silhouette"], certified["error"]
    metrics["silhouette_sq"] = CU.silhouette_squared(clustered, feats).first()[0]
    metrics["rows_initial"], metrics["rows_kept"] = seen.get["rows"], left.get["rows"]
    metrics["outliers_removed"] = metrics["rows_initial"] - metrics["rows_kept"]
    ordered = materialise(CU.order_clusters(clustered, C.CLUSTER_FEATURE_SORT, mode=order_mode), "train_ordered")
    labelled = kept.join(ordered.select(id_col, "cluster"), id_col, "left")
    split = CL.hash_split(ordered, id_col)
    train_rows, test_rows = split.where(~F.col("is_test")), split.where(F.col("is_test"))
    scores = materialise(CL.knn_cv_scores(train_rows, feats, id_col, "cluster", max_points=max_points), "train_cv")
    best = CL.best_k(scores).first()
    metrics["knn_best_k"] = int(best["best_k"])
    points = train_rows.select(F.col(id_col).alias("id"), *feats, "cluster")
    metrics["knn_labelled_rows"] = points.count()
    pred = materialise(CL.knn_predict(test_rows, points, feats, int(best["best_k"]), "id", "cluster",
                                      max_points=max_points), "train_predictions")
    confusion = CL.confusion_matrix(pred, "cluster", "prediction")
    report = CL.classification_report(pred, "cluster", "prediction")
    model = KnnModel(scaler, points, feats, int(best["best_k"]), "id", "cluster")
    centres = CU.model_centres(rfm.sparkSession, kmodel, feats)
    stages = box_tables("initial", rfm, feats).unionByName(box_tables("kept", kept, feats)) \
        .unionByName(box_tables("scaled", scaled, feats))
    params = {"n_clusters": k, "init": "k-means||", "algorithm": "lloyd", "max_iter": C.KMEANS_MAX_ITER,
              "tol": C.KMEANS_TOL, "outlier_mode": outlier_mode, "order_mode": order_mode,
              "knn_weights": C.KNN_WEIGHTS, "knn_folds": C.KNN_FOLDS, "knn_max_points": max_points}
    return TrainResult(labelled, ordered, sse, scores, confusion, report, model, centres, stages, metrics, params)


RUN_SCHEMA = "run_id string, kind string, name string, step int, value double, text string"


def run_metrics(result: TrainResult, run_id: str) -> DataFrame:
    """(run_id, kind, name, step, value, text): parameters, metrics, curves, the confusion matrix, the
    report and the box numbers of a run in one table."""
    spark = result.labelled.sparkSession
    rows = [(run_id, "param", name, None, None, str(v)) for name, v in result.params.items()]
    rows += [(run_id, "metric", name, None, float(v), None) for name, v in result.metrics.items() if v is not None]
    out = spark.createDataFrame(rows, RUN_SCHEMA)

    def more(df: DataFrame, kind: str, name, step, value) -> DataFrame:
        return df.select(F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"), name.alias("name"),
                         step.cast("int").alias("step"), value.cast("double").alias("value"),
                         F.lit(None).cast("string").alias("text")).where(F.col("value").isNotNull())

    nothing = F.lit(None).cast("int")
    if result.sse is not None:
        for name in ("sse", "silhouette_sq", "silhouette"):
            out = out.unionByName(more(result.sse, "curve", F.lit(name), F.col("k"), F.col(name)))
    out = out.unionByName(more(result.knn_scores, "curve", F.lit("knn_accuracy"), F.col("k"), F.col("accuracy")))
    out = out.unionByName(more(result.confusion, "confusion", F.concat_ws(":", "label", "prediction"), nothing, F.col("n")))
    for name in ("precision", "recall", "f1", "support"):
        out = out.unionByName(more(result.report, "report", F.concat_ws(":", "class", F.lit(name)), nothing, F.col(name)))
    if result.stages is not None:
        for name in ("n", "q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers"):
            out = out.unionByName(more(result.stages, "box", F.concat_ws(":", "stage", "feature", F.lit(name)), nothing,
                                       F.col(name)))
    return out


def write_run_rows(rows: DataFrame, path: str) -> None:
    """Put the ``run_metrics`` rows into the table at ``path``, partitioned by run: the rows of the same runs
    are replaced, all others stay, so writing a run again, after a failure or not, leaves its rows once."""
    rows.coalesce(1).write.partitionBy("run_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_run(result: TrainResult, path: str, run_id: str) -> None:
    """The sinks of a run below ``path``: ``labelled``, ``centres`` and ``model``, replaced, and the table
    ``runs``, in which the rows of this ``run_id`` are replaced."""
    write_parquet(result.labelled, f"{path}/labelled")
    write_parquet(result.centres, f"{path}/centres")
    save_model(result.model, f"{path}/model")
    write_run_rows(run_metrics(result, run_id), f"{path}/runs")
