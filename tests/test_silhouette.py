"""The certified Euclidean silhouette against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from custseg.operators import silhouette as S
from custseg.operators.silhouette import silhouette

FEATURES = ["a", "b", "c"]
SCHEMA = "id long, a double, b double, c double, cluster int"


def brute(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    names, out = np.unique(labels), []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in names if c != labels[i])
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def rows(x, labels):
    return [(n, *map(float, v), int(c)) for n, (v, c) in enumerate(zip(x, labels))]


def clumps(rng, n, k, spread=1.0):
    centres = rng.normal(size=(k, 3)) * 4
    labels = rng.integers(0, k, n)
    return centres[labels] + rng.normal(size=(n, 3)) * spread, labels


def test_group_sums_stay_within_their_certified_error():
    rng = np.random.default_rng(0)
    for _ in range(200):
        y = rng.normal(size=(30, 3)) * rng.uniform(0.1, 2, 3)
        w = rng.integers(1, 9, 30).astype(float)
        mean = (y * w[:, None]).sum(0) / w.sum()
        cov, m3, radius = S.moments(y, w, mean)
        group = S.Groups(np.array([w.sum()]), mean[None], cov[None], np.array([m3]), np.array([radius]), np.array([0]))
        x = mean + rng.normal(size=(20, 3)) * rng.uniform(1, 10)
        d = np.sqrt(((x - mean) ** 2).sum(1))[:, None]
        exact = (np.sqrt(((x[:, None] - y[None]) ** 2).sum(2)) * w).sum(1)
        assert (np.abs(group.sums(x, d)[:, 0] - exact) <= np.array([group.error(r)[0] for r in d]) + 1e-9).all()


@pytest.mark.parametrize("relative", [0.0, 0.01, 0.3])
def test_chunk_sums_stay_within_their_certified_error(relative):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(200, 3)), rng.normal(size=(300, 3)) * 2 + 4
    w, cluster = rng.integers(1, 5, 300).astype(float), rng.integers(0, 3, 300)
    sums, errors = np.zeros((200, 4)), np.zeros((200, 4))
    S.add_chunk(x, S._leaves(x, np.arange(200), 64), y, w, cluster, relative, sums, errors)
    d = np.sqrt(((x[:, None] - y[None]) ** 2).sum(2)) * w
    exact = np.column_stack([d[:, cluster == c].sum(1) for c in range(3)])
    assert (np.abs(sums[:, :3] - exact) <= errors[:, :3] + 1e-9).all() and (sums[:, 3] == 0).all()
    assert (errors > 0).any() == (relative > 0.1)


@pytest.mark.parametrize("tolerance,max_cells", [(1e-9, 1024), (0.02, 1024), (0.02, 16)])
def test_silhouette_within_tolerance_of_all_pairs(spark, tolerance, max_cells):
    rng = np.random.default_rng(2)
    x, labels = clumps(rng, 1_500, 4)
    df = spark.createDataFrame(rows(x, labels), SCHEMA).repartition(5)
    got = silhouette(df, FEATURES, tolerance=tolerance, max_cells=max_cells, chunk_rows=40).first()
    assert got.error <= tolerance
    assert abs(got.silhouette - brute(x, labels)) <= got.error + 1e-9
    if tolerance > 1e-3:
        assert got.error > 0


def test_repeated_rows_singletons_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    x, labels = clumps(rng, 200, 3)
    x = np.vstack([x, np.repeat(x[:1], 150, 0), np.repeat(x[:1], 100, 0), [[50.0, 0.0, 0.0]]])
    labels = np.concatenate([labels, np.repeat(labels[0], 150), np.repeat((labels[0] + 1) % 3, 100), [9]])
    data = rows(x, labels)
    odd = [(1_000, None, 1.0, 1.0, 1), (1_001, 1.0, 1.0, 1.0, None), (1_002, float("nan"), 1.0, 1.0, 0)]
    df = spark.createDataFrame(data + odd, SCHEMA).withColumn("x", F.lit("q")).withColumn("w", F.lit(1))
    got = silhouette(df, FEATURES, tolerance=1e-9, chunk_rows=30).first()
    assert abs(got.silhouette - brute(x, labels)) < 1e-9 and got.error < 1e-9


def test_few_clusters_and_equal_places(spark):
    one = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 0), (2, 1.0, 0.0, 0.0, 0)], SCHEMA)
    assert tuple(silhouette(one, FEATURES).first()) == (None, None)
    assert tuple(silhouette(one.limit(0), FEATURES).first()) == (None, None)
    same = spark.createDataFrame([(n, 1.0, 1.0, 1.0, n % 2) for n in range(10)], SCHEMA)
    assert tuple(silhouette(same, FEATURES).first()) == (0.0, 0.0)


def test_opened_work_grows_with_the_rows():
    """Places that a block of rows meets one by one: a shrinking share of all places."""
    rng = np.random.default_rng(4)
    met = []
    for n in (2_000, 16_000):
        y = rng.uniform(size=(n, 3))
        leaves = S._leaves(y, np.arange(n), S.LEAF_ROWS)
        mean = np.array([y[leaf].mean(0) for leaf in leaves])
        parts = [S.moments(y[leaf], np.ones(len(leaf)), m) for leaf, m in zip(leaves, mean)]
        groups = S.Groups(np.array([len(leaf) for leaf in leaves]), mean, np.array([p[0] for p in parts]),
                          np.array([p[1] for p in parts]), np.array([p[2] for p in parts]), np.zeros(len(leaves), int))
        block = y[leaves[len(leaves) // 2]]
        d = np.sqrt(((block[:, None] - mean[None]) ** 2).sum(2)).min(0)
        met.append(float(groups.n[groups.error(d) > 0.01 * groups.n * d].sum()))
    assert met[1] < 3 * met[0]


@pytest.mark.parametrize("width,order", [(1, 8), (2, 8), (3, 8), (4, 6), (6, 4)])
def test_higher_orders_stay_within_their_certified_error(width, order):
    assert S.order_for(width, 1e-5) == order and S.order_for(width, 0.01) == 2 and S.order_for(40, 1e-5) == 2
    rng = np.random.default_rng(5)
    for _ in range(20):
        y = rng.normal(size=(30, width)) * rng.uniform(0.1, 2, width)
        w = rng.integers(1, 9, 30).astype(float)
        mean = (y * w[:, None]).sum(0) / w.sum()
        coef, high, radius = S.moments(y, w, mean, order)
        group = S.Groups(np.array([w.sum()]), mean[None], coef[None], np.array([high]), np.array([radius]), np.array([0]), order)
        x = mean + rng.normal(size=(20, width)) * rng.uniform(1, 10)
        d = np.sqrt(((x - mean) ** 2).sum(1))[:, None]
        exact = (np.sqrt(((x[:, None] - y[None]) ** 2).sum(2)) * w).sum(1)
        assert (np.abs(group.sums(x, d)[:, 0] - exact) <= np.array([group.error(r)[0] for r in d]) + 1e-9).all()


def test_a_tight_tolerance_leaves_far_rows_closed():
    """Rows a few radii away are summed from moments even at a relative error of 1e-6, at once or gathered."""
    rng = np.random.default_rng(6)
    x, y = rng.uniform(size=(300, 3)), rng.uniform(size=(1_500, 3)) + [2.5, 0, 0]
    w, cluster = rng.integers(1, 5, 1_500).astype(float), rng.integers(0, 2, 1_500)
    d = np.sqrt(((x[:, None] - y[None]) ** 2).sum(2)) * w
    exact = np.column_stack([d[:, cluster == c].sum(1) for c in range(2)])
    blocks = S._leaves(x, np.arange(300), 64)
    for pending, allowed in ((None, None), ([[] for _ in blocks], np.full((len(blocks), 2), 4e-6))):
        sums, errors = np.zeros((300, 2)), np.zeros((300, 2))
        S.add_chunk(x, blocks, y, w, cluster, 1e-6, sums, errors, 8, None, allowed, pending)
        for block, far in zip(blocks, pending or []):
            if far:
                S.add_far(x, block, far, sums)
        assert (np.abs(sums - exact) <= errors + 1e-9).all()
        assert (errors > 0).all() and (errors <= 5e-6 * exact).all()


def test_cuts_are_even_on_few_distinct_values():
    """The widest dimension holds few values: a cut at the median of 0, 1, 1 would leave nothing on the right."""
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.choice([0.0, 10.0, 20.0], 8_000, p=[0.3, 0.3, 0.4]), rng.uniform(size=8_000), rng.uniform(size=8_000)])
    sizes = np.bincount(S.Cuts(x, 6).cell(x), minlength=64)
    assert sizes.min() > 0 and sizes.max() < 4 * len(x) / 64


def test_tight_tolerance_with_teams_and_discrete_features(spark):
    rng = np.random.default_rng(8)
    x, labels = clumps(rng, 2_500, 4)
    x[:, 1] = np.round(x[:, 1])
    df = spark.createDataFrame(rows(x, labels), SCHEMA).repartition(5)
    got = silhouette(df, FEATURES, tolerance=1e-4, chunk_rows=16).first()
    assert 0 < got.error <= 1e-4
    assert abs(got.silhouette - brute(x, labels)) <= got.error + 1e-9
