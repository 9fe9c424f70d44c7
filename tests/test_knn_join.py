"""The exact join against brute force: ties, hot places, folds, odd rows, blocks of every size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from custseg.operators import classify as CL
from custseg.operators import score as SC
from custseg.operators.knn_join import SLACK, _nearest_in_block, _squared, index_points, knn_join
from custseg.operators.prepare import ScalerModel
from custseg.sources.model_store import KnnModel


def brute(queries, points, k, folds=False):
    """queries (uid, fold, x), points (id, label, fold, x) -> {uid: [(distance, id, label)]}"""
    out = {}
    for uid, fold, x in queries:
        near = []
        for i, label, point_fold, y in points:
            if folds and fold == point_fold:
                continue
            d2 = 0.0
            for a, b in zip(x, y):
                d2 += (a - b) * (a - b)
            near.append((d2, i, label))
        out[uid] = [(float(np.sqrt(d)), i, label) for d, i, label in sorted(near)[:k]]
    return out


def clustered(rng, n, width):
    """Points in clumps on a coarse grid, so that many distances are equal, and a hot place."""
    centres = rng.normal(size=(6, width)) * 5
    x = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, width)) * rng.choice([0.1, 1.0, 3.0], (n, 1))
    x = np.round(x, 1)
    x[: n // 3] = x[0]
    return x


@pytest.mark.parametrize("width,k,max_pivots,block_rows", [(2, 5, 1024, 4096), (3, 7, 5, 20), (1, 47, 9, 3), (16, 4, 8, 50)])
def test_join_equals_brute_force(spark, width, k, max_pivots, block_rows):
    rng = np.random.default_rng(width)
    x, q = clustered(rng, 400, width), clustered(rng, 150, width) + rng.choice([0, 0, 0.05, 40], (150, 1))
    ids = rng.permutation(400)
    points = [(int(i), int(i) % 3, int(i) % 4, v.tolist()) for i, v in zip(ids, x)]
    queries = [(n, n % 4, v.tolist()) for n, v in enumerate(q)]
    pdf = spark.createDataFrame(points, "id long, label int, fold int, x array<double>").repartition(5)
    qdf = spark.createDataFrame(queries, "uid long, fold int, x array<double>").repartition(3)
    for folds in (False, True):
        got = knn_join(qdf, pdf, "x", k, "id", "label", "fold" if folds else None, max_pivots=max_pivots,
                       block_rows=block_rows)
        found = {r.uid: [(n.distance, n.id, n.label) for n in r.neighbours] for r in got.collect()}
        assert found == brute(queries, points, k, folds)


def test_blocks_are_bounded_and_border_queries_visit_few(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(20_000, 3))
    df = spark.createDataFrame([(n, *map(float, v)) for n, v in enumerate(x)], "id long, a double, b double, c double")
    bounds, blocks = index_points(df, ["a", "b", "c"], 5, "id", block_rows=100)
    assert blocks.agg(F.max("n")).first()[0] <= 100 and blocks.agg(F.sum("n")).first()[0] == 20_000
    d = np.sqrt(((x[:500, None] - bounds.pivots[None]) ** 2).sum(2))
    visited = sum(len(rows) for _, rows in bounds.visits(d, bounds.threshold(d, 5, -1)))
    assert visited / 500 < 0.15 * len(bounds.block)


def test_hot_place_costs_k_rows(spark):
    df = spark.range(5_000).select("id", F.lit(1).alias("y"), F.when(F.col("id") % 2 == 0, F.array(F.lit(1.0), F.lit(2.0)))
                                   .otherwise(F.array(F.col("id") * 1.0, F.lit(0.0))).alias("x"))
    _, blocks = index_points(df, "x", 3, "id", "y")
    assert blocks.agg(F.sum("n")).first()[0] == 2_500 + 3


def test_odd_rows(spark):
    points = [(1, 0, [0.0, 0.0]), (None, 1, [0.0, 0.0]), (2, None, [0.0, 0.0]), (3, 0, None), (4, 0, [float("nan"), 0.0]),
              (5, 2, [3.0, 4.0]), (5, 2, [3.0, 4.0]), (6, 2, [float("inf"), 0.0]), (7, 1, [None, 1.0])]
    pdf = spark.createDataFrame(points, "id long, label int, x array<double>")
    queries = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (None, [3.0, 4.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0])]
    qdf = spark.createDataFrame(queries, "uid long, x array<double>").withColumn("row", F.lit("a")).withColumn("near", F.lit(1))
    got = [(r.uid, [(n.distance, n.id, n.label) for n in r.neighbours]) for r in knn_join(qdf, pdf, "x", 3, "id", "label").collect()]
    home = [(0.0, None, 1), (0.0, 1, 0), (5.0, 5, 2)]
    away = [(0.0, 5, 2), (0.0, 5, 2), (5.0, None, 1)]
    assert sorted(got, key=str) == sorted([(1, home), (1, home), (None, away), (2, []), (3, []), (4, [])], key=str)
    empty = knn_join(qdf, pdf.where("id > 100"), "x", 3, "id", "label")
    assert empty.columns == ["uid", "x", "row", "near", "neighbours"] and all(r.neighbours == [] for r in empty.collect())
    assert knn_join(qdf.limit(0), pdf, "x", 3, "id", "label").count() == 0
    with pytest.raises(Exception, match="does not have"):
        knn_join(qdf, pdf.unionByName(spark.createDataFrame([(9, 1, [1.0])], pdf.schema)), "x", 3, "id", "label").collect()


def test_vote_and_cross_validation_equal_the_broadcast_way(spark):
    rng = np.random.default_rng(3)
    x = clustered(rng, 600, 2)
    df = spark.createDataFrame([(n, *map(float, v), int(rng.integers(0, 3))) for n, v in enumerate(x)],
                               "id long, a double, b double, y int")
    split = CL.hash_split(df, "id")
    train, test = split.where("not is_test"), split.where("is_test")
    pick = lambda d: sorted((r.id, r.prediction) for r in d.collect())
    assert pick(CL.knn_predict(test, train, ["a", "b"], 5, "id", "y")) == \
        pick(CL.knn_predict(test, train, ["a", "b"], 5, "id", "y", max_points=10))
    curve = lambda **o: {r.k: round(r.accuracy, 12) for r in CL.knn_cv_scores(train, ["a", "b"], "id", "y", **o).collect()}
    assert curve() == curve(max_points=10)
    model = KnnModel(ScalerModel({"a": 0.5, "b": 1.0}, {"a": 2.0, "b": 1.0}), train.select("id", "a", "b", F.col("y").alias("cluster")),
                     ["a", "b"], 5)
    rows = test.select("id", "a", "b").unionByName(spark.createDataFrame([(None, 1.0, None)], "id long, a double, b double"))
    tell = lambda d: sorted(((r.id, r.segment) for r in d.collect()), key=str)
    assert tell(SC.score(rows, model)) == tell(SC.score(rows, model, max_points=10))


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e200])
def test_wide_points_give_the_neighbours_of_direct_sums(spark, offset):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, size=(400, 20)).astype(float) + rng.choice([0.0, 0.001], (400, 1)) + offset
    q, folds, point_folds = x[::4].copy(), rng.integers(0, 3, 100), rng.integers(0, 3, 400)
    d2 = _squared(q, x)
    d2[folds[:, None] == point_folds[None, :]] = np.inf
    at = np.argsort(d2, axis=1, kind="stable")[:, :7]
    points = CL.Points(np.arange(400), np.zeros(400, int), point_folds, x, 400)
    dist, found = CL._nearest(q, points, 7, folds)
    assert np.array_equal(found, at) and np.array_equal(dist, np.sqrt(np.take_along_axis(d2, at, 1)))
    near, far = _nearest_in_block(q, np.full(100, 5.0), folds, x, point_folds, 7)
    d2[d2 > (5 + SLACK * 6) ** 2] = np.inf
    want = np.sort(d2, axis=1)[:, :7]
    assert np.array_equal(far, want)
    assert np.array_equal(np.take_along_axis(d2, near, 1)[np.isfinite(far)], want[np.isfinite(far)])


def test_wide_points_make_few_blocks(spark):
    """Balls prune little in many dimensions, so a query that has to see all points visits few blocks."""
    x = np.random.default_rng(5).normal(size=(2000, 24))
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>").repartition(3)
    bounds, blocks = index_points(points, "x", 3, "id")
    assert len(bounds.pivots) == 1 and blocks.agg(F.sum("n")).first()[0] == 2000
