"""Nearest-neighbour classification: deterministic splits, exact KNN, cross-validation,
evaluation tables.

Up to ``max_points`` labelled rows are broadcast once as a matrix, and every row to classify is
compared with all of them in an Arrow-batched column function, in place. More labelled rows are met by
the exact join of ``knn_join``; both ways give the same neighbours. Distance ties break by the
training id.

Vote (weights = "distance"): each neighbour votes 1/d for its class; if any of the k
neighbours is at distance 0, only those vote (weight 1 each). The class with the largest
vote wins, ties to the smallest class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .knn_join import WIDE, _wide_nearest, knn_join


# ---------------------------------------------------------------------------
# Splits
# ---------------------------------------------------------------------------

def split_key(id_col: str, seed: int):
    """Reproducible 32-bit key from md5(id ':' seed); partition-independent."""
    h = F.substring(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(":"), F.lit(str(seed)))), 1, 8)
    return F.conv(h, 16, 10).cast("long")


def hash_split(df: DataFrame, id_col: str, test_size: float = C.KNN_TEST_SIZE, seed: int = C.KNN_SEED,
               n_folds: int = C.KNN_FOLDS) -> DataFrame:
    """Adds split_key, is_test (about ``test_size`` of rows) and fold (0..n_folds-1)."""
    k = split_key(id_col, seed)
    return (df.withColumn("split_key", k)
            .withColumn("is_test", (F.col("split_key") % 1000) < int(round(test_size * 1000)))
            .withColumn("fold", ((F.col("split_key") / 1000).cast("long") % n_folds).cast("int")))


# ---------------------------------------------------------------------------
# Exact KNN
# ---------------------------------------------------------------------------

@dataclass
class Points:
    """The labelled rows of a model, in order of their ids."""
    ids: np.ndarray
    labels: np.ndarray
    folds: np.ndarray
    x: np.ndarray
    n_labelled: int


def labelled_points(train: DataFrame, features: list[str] | str, train_id: str, label_col: str,
                    fold_col: str | None = None, max_points: int = C.KNN_MAX_POINTS) -> Points:
    """At most ``max_points`` labelled rows (smallest split key first, then id), with the number of
    all labelled rows in ``n_labelled``. The bound limits the points a task holds. Only the scoring of
    a stream by a larger model uses the points so chosen; tables are joined with all of them."""
    cols = [features] if isinstance(features, str) else list(features)
    rows = train.select(F.col(train_id).alias("_id"), F.col(label_col).cast("int").alias("_label"),
                        (F.col(fold_col).cast("int") if fold_col else F.lit(-1)).alias("_fold"), *cols) \
        .dropna(subset=["_label", *cols])
    n = rows.count()
    if n > max_points:
        rows = rows.orderBy(split_key("_id", C.KNN_SEED), "_id").limit(max_points)
    pdf = rows.toPandas().sort_values("_id", kind="stable")
    return Points(pdf["_id"].to_numpy(), pdf["_label"].to_numpy(np.int64), pdf["_fold"].to_numpy(np.int64),
                  _matrix([pdf[c] for c in cols]), n)


def _matrix(columns: list[pd.Series]) -> np.ndarray:
    """Feature columns, or one column of vectors, as a float matrix."""
    if len(columns) == 1 and len(columns[0]) and not np.isscalar(columns[0].iloc[0]):
        return np.vstack([np.asarray(v, np.float64) for v in columns[0]])
    return np.column_stack([c.to_numpy(np.float64) for c in columns])


def _nearest(x: np.ndarray, points: Points, k: int, folds: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distances and positions of the ``k`` nearest points of each row, by (distance, id); distances are
    summed dimension by dimension, in the order SQL uses. Points of the row's own fold are infinitely far."""
    if x.shape[1] >= WIDE:
        own = None if folds is None else folds[:, None] == points.folds[None, :]
        found = _wide_nearest(x, points.x, k, apart=own)
        if found is not None:
            return np.sqrt(found[1]), found[0]
    d2 = np.zeros((len(x), len(points.x)))
    for j in range(x.shape[1]):
        d = x[:, j:j + 1] - points.x[:, j][None, :]
        d2 += d * d
    if folds is not None:
        d2[folds[:, None] == points.folds[None, :]] = np.inf
    if k < d2.shape[1]:
        at = np.argpartition(d2, k - 1, axis=1)[:, :k]
        cut = np.take_along_axis(d2, at, 1).max(1)
        for i in np.flatnonzero((d2 <= cut[:, None]).sum(1) > k):   # ties at the k-th distance
            near = np.flatnonzero(d2[i] <= cut[i])
            at[i] = near[np.lexsort((near, d2[i][near]))[:k]]
    else:
        at = np.broadcast_to(np.arange(d2.shape[1]), d2.shape)
    d2 = np.take_along_axis(d2, at, 1)
    order = np.lexsort((at, d2), axis=1)
    return np.sqrt(np.take_along_axis(d2, order, 1)), np.take_along_axis(at, order, 1)


def _votes(x: np.ndarray, points: Points, ks: list[int], folds: np.ndarray | None) -> np.ndarray:
    """The class each ``k`` of ``ks`` votes for, -1 without neighbours: one running sum of weights
    per class over the sorted neighbours serves every k."""
    dist, at = _nearest(x, points, min(max(ks), len(points.x)), folds)
    return tally(dist, points.labels[at], ks)


def tally(dist: np.ndarray, labels: np.ndarray, ks: list[int]) -> np.ndarray:
    """The class each ``k`` of ``ks`` votes for, given each row's neighbours in order; missing ones are
    infinitely far."""
    found = np.isfinite(dist)
    zero = dist[:, :1] == 0
    weight = np.where(zero, dist == 0, np.where(found, 1.0 / np.where(dist > 0, dist, 1.0), 0.0))
    classes = np.unique(labels[found])
    if not len(classes):
        return np.full((len(dist), len(ks)), -1)
    total = np.cumsum(weight[:, :, None] * (labels[:, :, None] == classes), axis=1)
    picks = [classes[total[:, min(k, total.shape[1]) - 1].argmax(1)] for k in ks]
    return np.where(found[:, :1], np.column_stack(picks), -1)


def votes(points: Points, features: list, ks: list[int], fold_col: str | None = None) -> Column:
    """An array column: the class of each row by every k of ``ks`` (null without features or points).

    A column of the row itself: no id, no join, so rows with equal or null ids are scored one by
    one, in batches and streams alike.
    """
    spark = SparkSession.getActiveSession()
    shared = spark.sparkContext.broadcast(points)

    @F.pandas_udf("array<int>")
    def vote(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        known = shared.value
        for columns in batches:
            columns = [columns] if isinstance(columns, pd.Series) else list(columns)
            fold = columns.pop().to_numpy(np.int64) if fold_col else None
            whole = np.logical_and.reduce([c.notna().to_numpy() for c in columns])
            out = pd.Series([None] * len(columns[0]), dtype=object)
            rows = np.flatnonzero(whole)
            step = max(1, 4_000_000 // max(1, len(known.x)))     # bounds the distance matrix
            for lo in range(0, len(rows) if len(known.x) else 0, step):
                part = rows[lo:lo + step]
                got = _votes(_matrix([c.iloc[part] for c in columns]), known, ks,
                             None if fold is None else fold[part])
                for i, classes in zip(part, got.tolist()):
                    out.iat[i] = [None if c < 0 else c for c in classes]
            yield out

    columns = [F.col(f) if isinstance(f, str) else f for f in features]
    return vote(*columns, *([F.col(fold_col)] if fold_col else []))


def neighbour_votes(neighbours: str, ks: list[int]) -> Column:
    """An array column: the class of each row by every k of ``ks`` from a column of ``knn_join`` (null without
    neighbours)."""
    most = max(ks)

    @F.pandas_udf("array<int>")
    def vote(distances: pd.Series, labels: pd.Series) -> pd.Series:
        dist, label = np.full((len(distances), most), np.inf), np.zeros((len(distances), most), np.int64)
        for i, (d, c) in enumerate(zip(distances, labels)):
            dist[i, :len(d[:most])], label[i, :len(c[:most])] = d[:most], c[:most]
        return pd.Series([[None if c < 0 else c for c in row] if row[0] >= 0 else None
                          for row in tally(dist, label, ks).tolist()], dtype=object)

    return vote(F.transform(neighbours, lambda n: n["distance"]), F.transform(neighbours, lambda n: n["label"]))


def _voted(queries: DataFrame, train: DataFrame, features, ks: list[int], train_id: str, label_col: str,
           fold_col: str | None, out_col: str, max_points: int) -> DataFrame:
    """``queries`` with the array of the classes by every k: by broadcast where the labelled rows are at most
    ``max_points``, by the exact join beyond."""
    cols = [features] if isinstance(features, str) else list(features)
    if train.dropna(subset=[label_col, *cols]).count() <= max_points:
        points = labelled_points(train, features, train_id, label_col, fold_col, max_points)
        return queries.withColumn(out_col, votes(points, cols, ks, fold_col))
    near = knn_join(queries, train, features, max(ks), train_id, label_col, fold_col, out_col="_near")
    return near.withColumn(out_col, neighbour_votes("_near", ks)).drop("_near")


def knn_predict(queries: DataFrame, train: DataFrame, features, k: int, train_id: str, label_col: str,
                out_col: str = "prediction", max_points: int = C.KNN_MAX_POINTS) -> DataFrame:
    """``queries`` with their class by a distance-weighted vote of the k nearest of all labelled rows."""
    return _voted(queries, train, features, [k], train_id, label_col, None, out_col, max_points) \
        .withColumn(out_col, F.col(out_col)[0])


def knn_cv_scores(train: DataFrame, features, id_col: str, label_col: str, fold_col: str = "fold",
                  ks=C.KNN_K_RANGE, max_points: int = C.KNN_MAX_POINTS) -> DataFrame:
    """(k, accuracy): mean over folds of the fold accuracy, each fold's rows classified by
    the rows of the other folds. One top-max(k) search per row serves every k."""
    voted = _voted(train, train, features, list(ks), id_col, label_col, fold_col, "_p", max_points)
    preds = voted.select(F.col(label_col).cast("int").alias("_y"), F.col(fold_col).alias("_f"), "_p") \
        .where(F.col("_p").isNotNull())
    kk = F.array(*[F.lit(k) for k in ks])
    per = preds.select("_f", "_y", F.explode(F.arrays_zip(kk.alias("k"), F.col("_p").alias("p"))).alias("col"))
    per = per.select("_f", F.col("col.k").alias("k"),
                     F.coalesce(F.col("col.p") == F.col("_y"), F.lit(False)).cast("int").alias("ok"))
    fold_acc = per.groupBy("k", "_f").agg(F.avg("ok").alias("acc"))
    return fold_acc.groupBy("k").agg(F.avg("acc").alias("accuracy"))


def best_k(scores: DataFrame) -> DataFrame:
    """Row with the highest accuracy; ties -> smallest k."""
    return scores.agg(F.min_by(F.struct("k", "accuracy"),
                               F.struct((-F.col("accuracy")).alias("a"), F.col("k").alias("k"))).alias("b")) \
        .select(F.col("b.k").alias("best_k"), F.col("b.accuracy").alias("accuracy"))


# ---------------------------------------------------------------------------
# Evaluation tables
# ---------------------------------------------------------------------------

def pair_counts(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(label, prediction, count): the one pass over the predictions that every evaluation
    table is derived from; checkpointed (at most k x k rows) so the scoring lineage runs once."""
    from ..session import cut_lineage
    return cut_lineage(pred.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("prediction"))
                       .agg(F.count(F.lit(1)).alias("count")))


def confusion_matrix(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(label, prediction, n, rate) over the complete label x label grid; rate = n / row sum
    (0 when the row is empty)."""
    counts = pair_counts(pred, label_col, pred_col)
    classes = (counts.select(F.col("label").alias("c")).union(counts.select(F.col("prediction").alias("c")))
               .where(F.col("c").isNotNull()).distinct())
    ks = sorted(r[0] for r in classes.collect())          # k class labels (k-row summary)
    grid = classes.select(F.col("c").alias("label"),
                          F.explode(F.array(*[F.lit(k) for k in ks])).alias("prediction"))
    full = grid.join(counts, ["label", "prediction"], "left").fillna(0, ["count"])
    rows = full.groupBy("label").agg(F.sum("count").alias("_row"))
    return (full.join(rows, "label")
            .select("label", "prediction", F.col("count").alias("n"),
                    F.when(F.col("_row") > 0, F.col("count") / F.col("_row")).otherwise(0.0).alias("rate")))


def classification_report(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, support) per class, plus rows 'accuracy',
    'macro avg', 'weighted avg'; 0 where a denominator is 0. All from the k x k counts."""
    cnt = pair_counts(pred, label_col, pred_col)
    tp = cnt.where(F.col("label") == F.col("prediction")).groupBy(F.col("label").alias("c")) \
        .agg(F.sum("count").alias("tp"))
    sup = cnt.groupBy(F.col("label").alias("c")).agg(F.sum("count").alias("support"))
    npred = cnt.groupBy(F.col("prediction").alias("c")).agg(F.sum("count").alias("npred"))
    classes = cnt.select(F.col("label").alias("c")).union(cnt.select(F.col("prediction").alias("c"))).distinct()
    t = (classes.join(tp, "c", "left").join(sup, "c", "left").join(npred, "c", "left")
         .fillna(0, ["tp", "support", "npred"]))
    prec = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    t = t.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    per = t.withColumn("f1", f1).select(F.col("c").cast("string").alias("class"), "precision", "recall",
                                        "f1", F.col("support").cast("long").alias("support"))
    n = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), n.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"), n.alias("support"))
    ok = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0))
    acc_v = ok / F.sum("count")
    acc = cnt.agg(F.lit("accuracy").alias("class"), acc_v.alias("precision"), acc_v.alias("recall"),
                  acc_v.alias("f1"), F.sum("count").cast("long").alias("support"))
    return per.unionByName(macro).unionByName(weighted).unionByName(acc)
