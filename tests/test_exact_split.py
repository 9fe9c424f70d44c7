"""Exact sizes of the split and the folds, by numpy's order of the keys."""

import hashlib

import pytest
from pyspark.sql import functions as F

from custseg.operators.exact_split import cut_points, exact_split


def key(i, seed):
    return int(hashlib.md5(f"{i}:{seed}".encode()).hexdigest()[:8], 16)


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_sizes_are_exact_and_rows_are_the_first_by_key(spark, n):
    df = spark.range(n).select((F.col("id") * 13 + 5).alias("id")).withColumn("is_test", F.lit("old"))
    rows = exact_split(df.repartition(3), "id").collect()
    ids = [i * 13 + 5 for i in range(n)]
    n_test = -(-3 * n // 10)
    test = set(sorted(ids, key=lambda i: (key(i, 512), i))[:n_test])
    left = sorted((i for i in ids if i not in test), key=lambda i: (key(i, 513), i))
    folds, at = {}, 0
    for f in range(4):
        size = len(left) // 4 + (f < len(left) % 4)
        folds |= dict.fromkeys(left[at:at + size], f)
        at += size
    assert {r.id: (r.is_test, r.fold) for r in rows} == {i: (i in test, folds.get(i)) for i in ids}


def test_equal_keys_are_cut_by_id(spark):
    rows = [(5, 1), (5, 3), (5, 2), (5, None), (4, 9), (6, 0), (1 << 31, 7)]
    df = spark.createDataFrame(rows, "key long, id long")
    order = [(4, 9), (5, None), (5, 1), (5, 2), (5, 3), (6, 0), (1 << 31, 7)]
    assert cut_points(df, list(range(8))) == [*order, None]
    assert cut_points(df.limit(0), [0]) == [None]


def test_repeated_ids_stay_together(spark):
    df = spark.createDataFrame([("a",)] * 30 + [(None,)] * 5 + [(f"b{i}",) for i in range(30)], "id string")
    rows = exact_split(df, "id").collect()
    assert len(rows) == 65 and len({(r.is_test, r.fold) for r in rows if r.id == "a"}) == 1
    assert len({(r.is_test, r.fold) for r in rows if r.id is None}) == 1
    assert exact_split(df.limit(0), "id").count() == 0
