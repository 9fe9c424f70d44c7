"""Quantile transform, IQR outliers and scaling against numpy re-computations."""

import random
from statistics import NormalDist

import numpy as np
import pytest

from custseg.functions import quantiles
from custseg.operators import prepare


def _expected_qnormal(x, n_quantiles=50):
    x = np.asarray(x, dtype=float)
    m = min(n_quantiles, len(x))
    refs = np.linspace(0, 1, m)
    q = np.maximum.accumulate(np.percentile(x, refs * 100))
    p = 0.5 * (np.interp(x, q, refs) - np.interp(-x, -q[::-1], -refs[::-1]))
    p[x + 1e-7 > q[-1]] = 1.0
    p[x - 1e-7 < q[0]] = 0.0
    nd = NormalDist()
    eps = np.spacing(1)
    lo, hi = nd.inv_cdf(1e-7 - eps), nd.inv_cdf(1 - (1e-7 - eps))
    z = np.array([-np.inf if v <= 0 else np.inf if v >= 1 else nd.inv_cdf(v) for v in p])
    return np.clip(z, lo, hi)


def test_quantile_normal_matches_reference_algorithm(spark):
    rnd = random.Random(5)
    vals = [float(rnd.choice([1, 2, 2, 3, 5, 8, 13])) if i % 3 else rnd.lognormvariate(3, 1.2)
            for i in range(700)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    model = prepare.fit_quantile_transform(df, ["x"])
    got = {r.id: r.x for r in prepare.quantile_transform(df, ["x"], model).collect()}
    exp = _expected_qnormal(vals)
    assert max(abs(got[i] - exp[i]) for i in range(len(vals))) < 1e-9


def test_quantile_normal_fewer_rows_than_quantiles(spark):
    vals = [3.0, 1.0, 2.0, 10.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    model = prepare.fit_quantile_transform(df, ["x"])
    assert len(model.references) == 4
    got = [r.x for r in prepare.quantile_transform(df, ["x"], model).orderBy("id").collect()]
    assert np.allclose(got, _expected_qnormal(vals))


def _rfm_fixture(spark):
    rnd = random.Random(9)
    rows = [(i, float(rnd.randint(1, 300)), float(rnd.randint(2, 12)), rnd.uniform(100, 2000))
            for i in range(300)]
    rows.append((1000, 99999.0, 5.0, 500.0))     # extreme recency only
    rows.append((1001, 50.0, 5.0, 1e7))          # extreme monetary
    return spark.createDataFrame(rows, "customer_id long, recency double, frequency double, monetary double")


@pytest.mark.parametrize("mode", ["last", "any"])
def test_remove_outliers_modes(spark, mode):
    df = _rfm_fixture(spark)
    kept = {r.customer_id for r in prepare.remove_outliers(df, mode=mode).collect()}
    assert 1001 not in kept
    assert (1000 in kept) == (mode == "last")


def test_remove_outliers_equals_direct_filter(spark):
    """Thresholds in raw units give exactly the rows a direct filter on scores gives."""
    df = _rfm_fixture(spark)
    feats = ["recency", "frequency", "monetary"]
    model = prepare.fit_quantile_transform(df, feats)
    t = prepare.quantile_transform(df, feats, model, suffix="_z").toPandas()
    expect = set(t.customer_id)
    for f in feats:
        q1, q3 = np.percentile(t[f + "_z"], [25, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        bad = set(t.customer_id[(t[f + "_z"] < lo) | (t[f + "_z"] > hi)])
        expect -= bad
    got = {r.customer_id for r in prepare.remove_outliers(df, feats, mode="any").collect()}
    assert got == expect


def test_standard_scale(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 6.0, 5.0)], "id long, a double, b double")
    scaled, model = prepare.scale_data(df, ["a", "b"])
    pdf = scaled.toPandas()
    assert abs(pdf.a.mean()) < 1e-12 and abs(pdf.a.std(ddof=0) - 1) < 1e-12
    assert model.scale["b"] == 1.0 and (pdf.b == 0).all()


def test_exact_sum_scaler_matches_population_std(spark):
    rnd = random.Random(13)
    rows = [(i, float(rnd.randint(0, 900)), round(rnd.uniform(10, 90000), 2)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, a double, m double")
    m = prepare.fit_standard_scaler(df, ["a", "m"])
    for j, f in enumerate(["a", "m"]):
        x = np.array([r[j + 1] for r in rows])
        assert abs(m.mean[f] - x.mean()) < 1e-9 * max(1, abs(x.mean()))
        assert abs(m.scale[f] - x.std(ddof=0)) < 1e-9 * x.std(ddof=0)


def test_exact_quantiles_against_numpy(spark):
    import numpy as np
    from custseg.functions.quantiles import exact_quantiles
    rng = np.random.default_rng(3)
    rows = [(str(i % 3), float(np.round(rng.normal(), 2)), None if i % 7 == 0 else float(i)) for i in range(500)]
    rows += [("lone", 5.0, None), (None, 1.0, 2.0), (None, 3.0, None)]
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(5)
    levels = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.feature): (r.n, r.q) for r in exact_quantiles(df, ["a", "b"], levels, by="g").collect()}
    for g in {r[0] for r in rows}:
        for j, f in ((1, "a"), (2, "b")):
            x = [r[j] for r in rows if r[0] == g and r[j] is not None]
            assert ((g, f) in got) == bool(x)
            if x:
                assert got[g, f][0] == len(x) and np.allclose(got[g, f][1], np.quantile(x, levels), rtol=1e-12)


def test_empty_and_constant_inputs(spark):
    from custseg.operators import summaries, tiers
    empty = spark.createDataFrame([], "recency double, frequency double, monetary double")
    assert prepare.remove_outliers(empty).count() == 0
    assert prepare.scale_data(empty)[0].count() == 0
    assert tiers.rfm_tiers(empty).count() == 0
    assert summaries.density(empty, "recency").count() == 0
    assert summaries.box_stats(empty, "recency").count() == 0
    assert summaries.histogram(empty, "recency").agg({"count": "sum"}).first()[0] == 0
    same = spark.createDataFrame([(1.0, 2.0, 3.0)] * 4, empty.schema)
    assert prepare.remove_outliers(same).count() == 4
    assert summaries.density(same, "recency").count() == 0
    assert summaries.box_stats(same, "recency").first().median == 1.0
    assert [r["count"] for r in summaries.histogram(same, "recency").collect()] == [4]


@pytest.mark.parametrize("error", [0.05, 0.005])
def test_sketched_quantiles_keep_their_rank_error(spark, error):
    """Skewed, tied and sorted data, over several partitions: ranks stay within the error."""
    rng = np.random.default_rng(8)
    n = 20_000
    skewed, tied = rng.pareto(0.7, n), np.minimum(rng.geometric(0.4, n), 6).astype(float)
    rows = [(float(a), float(b), float(i), None) for i, (a, b) in enumerate(zip(skewed, tied))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(9)
    levels = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles.sketch_quantiles(df, ["a", "b", "c", "d"], levels, error)
    assert set(got) == {"a", "b", "c"}
    for name, x in (("a", skewed), ("b", tied), ("c", np.arange(n, dtype=float))):
        assert got[name][0] == n
        for level, v in zip(levels, got[name][1]):
            low, high = (x < v).mean(), (x <= v).mean()
            assert low - error - 1 / n <= level <= high + error + 1 / n
    with pytest.raises(ValueError):
        quantiles.sketch_quantiles(df, ["a"], levels, 0.0)


def test_sketch_is_an_option_and_never_the_default(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.normal(size=4_000))], "id long, a double")
    exact, sketched = prepare.fit_quantile_transform(df, ["a"]), prepare.fit_quantile_transform(df, ["a"], approx=0.01)
    assert np.allclose(exact.quantiles["a"], np.quantile([r.a for r in df.collect()], exact.references))
    assert exact.quantiles["a"] != sketched.quantiles["a"]
    kept = {r.id for r in prepare.remove_outliers(df, ["a"]).collect()} ^ {r.id for r in prepare.remove_outliers(df, ["a"], approx=0.001).collect()}
    assert len(kept) < 0.01 * 4_000
