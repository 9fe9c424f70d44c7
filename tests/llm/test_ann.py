import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from custseg.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, node long, c string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i) if i is not None else None, v if v is None else
                                   [None if x is None else float(x) for x in v], 0, 1, "c")
                                  for i, v in zip(ids, vectors)], SCHEMA)


def brute(vectors, ids, top=20):
    ok = [k for k, v in enumerate(vectors) if ids[k] is not None and v is not None and None not in v
          and np.isfinite(v).all() and np.any(v)]
    x = np.array([vectors[k] for k in ok], np.float32).astype(float)
    name = np.array([ids[k] for k in ok])
    out = {}
    for a in np.flatnonzero(name % 20 == 0):
        s = x @ x[a]
        other = np.arange(len(ok)) != a
        order = np.lexsort((name[other], -s[other]))[:top]
        out[name[a]] = list(zip(name[other][order], s[other][order]))
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    vectors = [list(centres[i % 30] + rng.normal(scale=0.4, size=16)) for i in range(1500)]  # of various lengths
    want = brute(vectors, list(range(1500)))
    got = ann.nearest(table(spark, vectors)).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for q, near in want.items():
        rows = sorted(found[q])
        assert [r[0] for r in rows] == list(range(1, 21))
        scores = [r[2] for r in rows]
        assert scores == sorted(scores, reverse=True)
        a = np.array(vectors[q], np.float32).astype(float)
        for _, v, s in rows:
            assert v != q and abs(s - a @ np.array(vectors[v], np.float32).astype(float)) < 1e-12
        hits += len({v for v, _ in near} & {v for _, v, _ in rows})
    assert set(found) == set(want)
    assert hits / (20 * len(want)) >= 0.95


def test_small_odd_and_equal_vectors(spark):
    same = [1.0, 2.0, 3.0]
    vectors = [same] * 60 + [[0, 0, 0], None, [1, None, 2], [float("nan"), 1, 1], [float("inf"), 1, 1], [1, 0, 0], [0, 1, 0]]
    ids = [*range(60), 60, 80, 100, 120, 140, 160, None]
    got = {}
    for r in ann.nearest(table(spark, vectors, ids)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert set(got) == {0, 20, 40, 160}
    for q in (0, 20, 40):
        assert [v for _, v in sorted(got[q])] == [i for i in range(60) if i != q][:20]
    assert [v for _, v in sorted(got[160])] == list(range(20))


def test_fewer_candidates_and_empty_table(spark):
    assert sorted((r.query_id, r.rank, r.vec_id) for r in ann.nearest(table(spark, [[1, 0], [0, 1], [1, 1]])).collect()) == \
        [(0, 1, 2), (0, 2, 1)]
    assert ann.nearest(table(spark, [[1, 0]])).count() == 0
    assert ann.nearest(table(spark, [])).count() == 0


def spread_recall(spark, n, seed):
    """Recall on unclustered 64-d vectors of spread norms with one huge outlier."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 64))
    x *= np.exp(rng.normal(scale=0.5, size=n))[:, None] / np.linalg.norm(x, axis=1)[:, None]
    x[7] *= 1000 / np.linalg.norm(x[7])
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": x.tolist()}), "vec_id long, embedding array<float>")
    found = {}
    for r in ann.nearest(frame).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    x = x.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, n, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & found[q])
    return hits / n


def test_recall_with_spread_norms_and_an_outlier(spark):
    assert spread_recall(spark, 10000, 5) >= 0.95


def test_search_expands_the_whole_beam(spark):
    # the best node hangs on the worst of the beam, the other nodes lead nowhere
    size = 30
    angle = np.r_[np.linspace(0.5, 1.0, size), 0.1]
    nodes = spark.createDataFrame(pd.DataFrame({"node": range(size + 1), "vec": np.column_stack([np.cos(angle), np.sin(angle)]).tolist()}),
                                  "node long, vec array<double>") \
        .select("node", ann._pack("vec").alias("packed"), F.lit(1.0).cast("float").alias("weight"))
    edges = spark.createDataFrame([(size - 1, size, 0.0)], "v long, w long, s float")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "q long, vec array<double>").select("q", ann._pack("vec").alias("packed"))
    first = spark.range(size).select(F.lit(1).cast("long").alias("q"), F.col("id").alias("c"))
    found = ann.search(queries, first, nodes, edges, beam=size, expand=4).collect()
    assert size in {r.node for r in found}


def test_repeated_identifiers_are_rows_of_their_own(spark):
    vectors = [[4, 0], [0, 3], [3, 1], [4, 0], [4, 0]]
    got = {}
    for r in ann.nearest(table(spark, vectors, [20, 20, 1, 20, 2])).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {20}
    large = [(1, 12.0), (2, 16.0), (20, 0.0), (20, 16.0)]  # of [4, 0], which stands there twice
    small = [(1, 3.0), (2, 0.0), (20, 0.0), (20, 0.0)]     # of [0, 3]
    assert sorted(got[20]) == sorted(large * 2 + small)


def test_first_graph_of_a_few_thousand_vectors_is_exact(spark):
    """Blocks are large matrix products: up to one block of nodes the descent starts from the true neighbours."""
    x = np.random.default_rng(8).normal(size=(1300, 12))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, vec array<double>")
    nodes = rows.select("node", ann._pack("vec").alias("packed"), F.lit(0).cast("long").alias("band"))
    bands = spark.createDataFrame([(0, 1300)], "band long, n long")
    got = {}
    for r in ann._block_graph(nodes, bands, 10, ann.BLOCK, 5).collect():
        got.setdefault(r.v, {})[r.w] = r.s
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit @ unit.T
    np.fill_diagonal(s, -np.inf)
    best = -np.sort(-s, axis=1)[:, :10]
    assert len(got) == 1300
    for v, near in got.items():
        assert v not in near and len(near) == 10
        assert np.allclose(sorted(near.values(), reverse=True), best[v], atol=1e-3)


def directions(spark, n, dims, seed):
    """Nodes of one band with unclustered directions, their bands and exact cosines."""
    x = np.random.default_rng(seed).normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, vec array<double>")
    nodes = ann.materialise(rows.select("node", ann._pack("vec").alias("packed"), F.lit(0).cast("long").alias("band")), "test_nodes")
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    return nodes, spark.createDataFrame([(0, n)], "band long, n long"), s


def test_first_graph_of_several_blocks_holds_most_neighbours(spark):
    """Blocks hold nodes that lie near one another, each node is in one block per tree, whatever was sampled."""
    nodes, bands, s = directions(spark, 3000, 12, 9)
    dealt = ann._dealt(nodes, bands, 400, 8, 5).groupBy("node").count().collect()
    assert len(dealt) == 3000 and {r["count"] for r in dealt} == {8}
    found = {}
    for r in ann._block_graph(nodes, bands, 10, 400, 5).collect():
        found.setdefault(r.v, set()).add(r.w)
    assert {len(v) for v in found.values()} == {10}
    hits = sum(len(set(np.argsort(-s[v])[:10].tolist()) & near) for v, near in found.items())
    assert hits / 30000 >= 0.85  # two draws of blocks by hash: 0.25


def test_rounds_stay_few_when_blocks_are_many(spark, monkeypatch):
    nodes, bands, s = directions(spark, 3000, 12, 10)
    written = []
    real = ann.materialise
    monkeypatch.setattr(ann, "materialise", lambda df, name, *a: (written.append(name), real(df, name, *a))[1])
    found = {}
    for r in ann.neighbour_graph(nodes, bands, k=20, joined=20, block=400).collect():
        found.setdefault(r.v, set()).add(r.w)
    hits = sum(len(set(np.argsort(-s[v])[:10].tolist()) & near) for v, near in found.items())
    assert hits / 30000 >= 0.95
    assert written.count("ann_edges") - 1 <= 2


def test_equal_directions_do_not_make_a_large_block(spark):
    """A cut cannot part equal directions; their leaf is cut by hash."""
    rows = spark.createDataFrame([(i, [1.0, 2.0, 2.0] if i % 4 else [float(i % 7), 1.0, float(i)]) for i in range(2000)],
                                 "node long, vec array<double>")
    nodes = rows.select("node", ann._pack("vec").alias("packed"), F.lit(0).cast("long").alias("band"))
    bands = spark.createDataFrame([(0, 2000)], "band long, n long")
    blocks = ann._dealt(nodes, bands, 100, 3, 5).groupBy("tree", "leaf", "part").count().collect()
    assert sum(r["count"] for r in blocks) == 6000
    assert max(r["count"] for r in blocks) <= 250
