"""Clustering operators against numpy brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from custseg.operators import cluster as CU


def _blobs(seed=1, n=90):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        c = i % 3
        rows.append((i, rnd.gauss(c * 10, 1), rnd.gauss(-c * 5, 1), rnd.gauss(c, 0.5)))
    return rows


def _np_silhouette(x, lab):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() <= 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == k].mean() for k in set(lab) if k != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def _np_db(x, lab):
    ks = sorted(set(lab))
    c = np.array([x[lab == k].mean(0) for k in ks])
    s = np.array([np.sqrt(((x[lab == k] - c[i]) ** 2).sum(1)).mean() for i, k in enumerate(ks)])
    r = []
    for i in range(len(ks)):
        r.append(max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(len(ks)) if j != i))
    return float(np.mean(r))


def test_assign_and_lloyd(spark):
    rows = _blobs()
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    cen = [[0, 0, 0], [10, -5, 1], [20, -10, 2]]
    lab = {r.id: r.cluster for r in CU.assign_clusters(df, ["a", "b", "c"], cen).collect()}
    x = np.array([r[1:] for r in rows])
    exp = np.argmin(((x[:, None, :] - np.array(cen)[None]) ** 2).sum(-1), axis=1)
    assert [lab[i] for i in range(len(rows))] == list(exp)
    new = {r.cluster: [r.a, r.b, r.c] for r in CU.lloyd_step(df, ["a", "b", "c"], cen).collect()}
    for k in range(3):
        assert np.allclose(new[k], x[exp == k].mean(0))


def test_kmeans_recovers_blobs(spark):
    df = spark.createDataFrame(_blobs(), "id long, a double, b double, c double")
    _, lab = CU.kmeans_fit(df, ["a", "b", "c"], k=3)
    groups = {}
    for r in lab.collect():
        groups.setdefault(r.cluster, set()).add(r.id % 3)
    assert all(len(v) == 1 for v in groups.values()) and len(groups) == 3
    sweep = CU.kmeans_sweep(df, ["a", "b", "c"], ks=[1, 2, 3]).collect()
    sse = {r.k: r.sse for r in sweep}
    sil = {r.k: r.silhouette_sq for r in sweep}
    assert sil[1] is None and 0.5 < sil[3] <= 1.0 and sil[3] > sil[2]
    x = np.array([r[1:] for r in _blobs()])
    assert abs(sse[1] - ((x - x.mean(0)) ** 2).sum()) < 1e-6 * sse[1]
    assert sse[1] > sse[2] > sse[3]


def test_silhouette_and_davies_bouldin_exact(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.random(), rnd.random(), rnd.random(), rnd.randint(0, 3)) for i in range(120)]
    rows.append((999, 5.0, 5.0, 5.0, 4))          # singleton cluster scores 0
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, c double, cluster int")
    x = np.array([r[1:4] for r in rows])
    lab = np.array([r[4] for r in rows])
    got = CU.silhouette_squared(df, ["a", "b", "c"]).first()[0]
    assert abs(got - _np_silhouette(x, lab)) < 1e-9
    db = CU.davies_bouldin(df, ["a", "b", "c"]).first()[0]
    assert abs(db - _np_db(x, lab)) < 1e-9


def test_order_clusters_both_modes(spark):
    # medians r/f/m: cluster 0 = 5/1/9, cluster 1 = 1/9/1, cluster 2 = 9/5/5
    rows = []
    for k, (r, f, m) in enumerate([(5, 1, 9), (1, 9, 1), (9, 5, 5)]):
        for j in range(3):
            rows.append((k * 10 + j, float(r), float(f), float(m), k))
    df = spark.createDataFrame(rows, "customer_id long, recency double, frequency double, monetary double, cluster int")
    by_m = {r.customer_id // 10: r.cluster for r in CU.order_clusters(df, mode="monetary").collect()}
    assert by_m == {1: 0, 2: 1, 0: 2}
    by_s = {r.customer_id // 10: r.cluster for r in CU.order_clusters(df, mode="rfm_score").collect()}
    assert by_s == {2: 0, 0: 1, 1: 2}


def test_kmeans_does_not_depend_on_partitions(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.random(), rnd.random(), rnd.random()) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    fits = [CU.kmeans_fit(df.repartition(p), ["a", "b", "c"], k=5) for p in (1, 4, 7)]
    labels = [sorted((r.id, r.cluster) for r in lab.collect()) for _, lab in fits]
    assert labels[0] == labels[1] == labels[2]
    for model, _ in fits:
        assert abs(model.sse - fits[0][0].sse) < 1e-9 and np.allclose(model.centres, fits[0][0].centres)
    sweep = CU.kmeans_sweep(df, ["a", "b", "c"], ks=[1, 2, 5]).collect()
    assert abs(sweep[2].sse - fits[0][0].sse) < 1e-9
    lab = np.array([c for _, c in labels[0]])
    x = np.array([r[1:] for r in rows])
    assert abs(sweep[2].silhouette_sq - _np_silhouette(x, lab)) < 1e-9


def test_parallel_seeds_do_not_depend_on_order_or_partitions(spark):
    rnd = random.Random(11)
    rows = [(i, rnd.gauss(0, 1) + 6 * (i % 5), rnd.gauss(0, 1), rnd.gauss(0, 3)) for i in range(3000)]
    rows += [(5_000 + i, 4.0, 4.0, 4.0) for i in range(1500)] + [(9_000, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    seeds = [CU.parallel_centres(df.orderBy(F.rand(p)).repartition(p), ["a", "b", "c"], [1, 3, 5, 14]) for p in (1, 4, 7)]
    assert seeds[0] == seeds[1] == seeds[2]
    assert {k: len(c) for k, c in seeds[0].items()} == {1: 1, 3: 3, 5: 5, 14: 14}


def test_parallel_seeding_draws_by_priority(spark):
    """The drawn rows are those with the smallest -ln(u) / (count x squared distance), by brute force."""
    rnd = random.Random(12)
    places = [(round(rnd.random(), 3), round(rnd.random() * 4, 3)) for _ in range(300)]
    df = spark.createDataFrame([p for p in places for _ in range(1 + int(p[0] * 5))], "a double, b double")
    table = {}
    for r in df.groupBy("a", "b").count().select("a", "b", "count", F.xxhash64(F.lit(CU.SEED), "a", "b").alias("h")).collect():
        table[r.a, r.b] = (r["count"], r.h)
    x = np.array(list(table))
    w, h = (np.array(v) for v in zip(*table.values()))

    def draw(centres, turn, n):
        d2 = ((x[:, None] - np.array(centres)[None]) ** 2).sum(2).min(1) if centres else np.ones(len(x))
        with np.errstate(divide="ignore"):
            key = -np.log(CU._uniform(h, turn)) / (w * d2)
        return [x[i].tolist() for i in np.lexsort((x[:, 1], x[:, 0], key))[:n]]

    drawn = draw([], 0, 1)
    for turn in range(1, 5):
        drawn += draw(drawn, turn, 2 * 6)
    near = ((x[:, None] - np.array(drawn)[None]) ** 2).sum(2).argmin(1)
    want = CU._recluster(np.array(drawn), np.bincount(near, w, len(drawn)), [2, 6])
    assert CU.parallel_centres(df, ["a", "b"], [2, 6]) == want


def test_parallel_seeds_end_no_worse_than_farthest_first(spark):
    from custseg.plans import catalog
    from tests.conftest import SF01
    scaled = catalog.rfm_scaled(spark, SF01)
    sse = {i: {r.k: r.sse for r in CU.kmeans_sweep(scaled, catalog.FEATS, init=i).collect()} for i in ("parallel", "farthest")}
    assert sum(sse["parallel"].values()) <= 1.01 * sum(sse["farthest"].values())
    rows = scaled.select(*catalog.FEATS).toPandas().to_numpy(float)
    starts = CU.parallel_centres(scaled, catalog.FEATS, list(range(1, 15)))
    for k, c in starts.items():
        assert abs(sse["parallel"][k] - _np_lloyd(rows, k, start=np.array(c))[1]) < 1e-3, k


def test_fewer_rows_than_centres(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, 4.0)], "a double, b double")
    assert CU.parallel_centres(df, ["a", "b"], [3])[3] in ([[1.0, 2.0], [3.0, 4.0], [1.0, 2.0]], [[3.0, 4.0], [1.0, 2.0], [3.0, 4.0]])
    assert CU.parallel_centres(df.limit(0), ["a", "b"], [3]) == {}
    with pytest.raises(ValueError, match="init"):
        CU.kmeans_fit(df, ["a", "b"], 2, init="random")


def test_empty_and_constant_rows(spark):
    empty = spark.createDataFrame([], "id long, a double")
    assert CU.kmeans_fit(empty, ["a"], k=2)[1].count() == 0
    assert CU.kmeans_sweep(empty, ["a"], ks=[1, 2]).count() == 0
    same = spark.createDataFrame([(i, 1.0) for i in range(5)], "id long, a double")
    assert {r.cluster for r in CU.kmeans_fit(same, ["a"], k=2)[1].collect()} == {0}
    assert CU.silhouette_squared(CU.kmeans_fit(same, ["a"], k=2)[1], ["a"]).first()[0] is None


def _np_lloyd(x, k, max_iter=300, tol=1e-4, start=()):
    chosen = list(start)
    while len(chosen) < k:
        c = np.array(chosen or [np.round(x.mean(0), 9)])
        d = ((x[:, None] - c[None]) ** 2).sum(-1).min(1) * (-1 if chosen else 1)
        chosen.append(x[np.lexsort((*x.T[::-1], d))[0]])
    c = np.array(chosen)
    for _ in range(max_iter):
        lab = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
        new = np.array([x[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(k)])
        shift, c = ((new - c) ** 2).sum(), new
        if shift <= tol * x.var(0).mean():
            break
    d = ((x[:, None] - c[None]) ** 2).sum(-1)
    return d.argmin(1), d.min(1).sum()


def test_kmeans_queries_run_to_the_production_tolerance(spark):
    from custseg.plans import catalog
    from tests.conftest import SF01
    rows = catalog.rfm_scaled(spark, SF01).select("customer_id", *catalog.FEATS).toPandas()
    x = rows[catalog.FEATS].to_numpy(float)
    sse = {r.k: r.sse for r in catalog.queries()["kmeans_sweep"](spark, SF01).collect()}
    for k in range(1, 15):
        assert abs(sse[k] - _np_lloyd(x, k)[1]) < 1e-3, k
    lab = {r.customer_id: r.cluster for r in catalog.queries()["kmeans_fit"](spark, SF01).collect()}
    assert [lab[i] for i in rows["customer_id"]] == list(_np_lloyd(x, 4)[0])


def test_unconverged_kmeans_warns(spark):
    df = spark.createDataFrame(_blobs(), "id long, a double, b double, c double")
    with pytest.warns(UserWarning, match="did not converge in 1 rounds"):
        CU.kmeans_fit(df, ["a", "b", "c"], k=3, max_iter=1, tol=0.0)
