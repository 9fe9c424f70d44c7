import random

from custseg.llm import mixing
from tests.llm.helpers import documents, sentence


def targets(sizes, share=1.5):
    """The contract by rounds: cut what is above twice its source, share the excess again."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, out, free = share * sum(sizes.values()), {}, list(names)
    while free:
        left = total - sum(out.values())
        level = left / sum(weight[s] for s in free)
        cut = [s for s in free if weight[s] * level > 2 * sizes[s]]
        if not cut:
            out.update({s: weight[s] * level for s in free})
            break
        out.update({s: 2.0 * sizes[s] for s in cut})
        free = [s for s in free if s not in cut]
    return out


def rows_of(seed, n=240):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "C", "é", None])
        rows.append((i, sentence(rng, rng.choice([0, 1, 5, 60, 300])) or None, source))
    return rows + [(7, "same row", "a"), (7, "same row", "a"), (None, "no id here", "b"), (900, " \t\n", "b")]


def test_targets_sizes_and_words(spark):
    rows = rows_of(3)
    got = mixing.taken_words(mixing.mix(documents(spark, rows, clash=True), shard_blocks=16)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    by_size = {(i, len((t or "").split())): s for i, t, s in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        source = by_size[r.doc_id, r["size"]]
        assert r.source_size == sizes[source]
        assert abs(r.target - want[source]) < 1e-6
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1


def test_reruns_and_partitions_agree(spark):
    rows = [(i, t, s) for i, t, s in rows_of(5) if i is not None and i != 7]
    one = mixing.taken_words(mixing.mix(documents(spark, rows).repartition(1))).select("doc_id", "taken").collect()
    five = mixing.taken_words(mixing.mix(documents(spark, rows).repartition(5))).select("doc_id", "taken").collect()
    assert sorted(one) == sorted(five)


def test_whole_documents_near_target(spark):
    rows = [r for r in rows_of(9) if r[0] is not None]
    docs = documents(spark, rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    texts = {t for _, t, _ in rows}
    assert all(r.text in texts for r in out.collect())
    words = sum(len((t or "").split()) for _, t, _ in rows)
    mixed = sum(len(r.text.split()) for r in out.collect())
    assert abs(mixed - 1.5 * words) <= 6 * 150


def test_splitting_tree_is_exact_and_fair(spark):
    quotas = spark.createDataFrame([(1, 1000), (2, 300), (3, 1), (4, 5000)], "source_no long, quota long")
    leaves = mixing.splitting_tree(quotas, 4).toPandas()
    assert leaves.groupby("source_no")["quota"].sum().to_dict() == {1: 1000, 2: 300, 3: 1, 4: 5000}
    assert set(leaves.groupby("shard")["quota"].sum()) == {393, 394}
    share = leaves[leaves.source_no == 1].set_index("shard")["quota"] / 394
    assert share.between(0.08, 0.26).all()  # 0.159 with standard deviation 0.018


def test_hypergeometric_moments(spark):
    x = spark.range(6000).selectExpr("(pmod(xxhash64(id), 1099511627776L) + 0.5D) / 1099511627776D AS u") \
        .selectExpr(mixing.hypergeometric("u", "300L", "1000L", "400L") + " AS x").toPandas()["x"]
    assert abs(x.mean() - 120) < 0.5
    assert abs(x.var() / (400 * 0.3 * 0.7 * 600 / 999) - 1) < 0.1
    edge = spark.range(1).selectExpr(mixing.hypergeometric("0.4D", "5L", "5L", "3L") + " AS a",
                                     mixing.hypergeometric("0.9D", "0L", "9L", "3L") + " AS b",
                                     mixing.hypergeometric("0.9D", "4L", "9L", "0L") + " AS c").first()
    assert tuple(edge) == (3, 0, 0)


def test_empty_table(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mixed_documents(documents(spark, [(1, None, "a"), (2, "", None)])).count() == 0
