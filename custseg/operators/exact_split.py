"""Train/test split and folds of exact sizes: rows in the order of hashed keys, cut at exact ranks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .classify import split_key

#: A 32-bit key is found by its upper and its lower half: two counts of at most this many rows each.
HALF = 1 << 16


def cut_points(keyed: DataFrame, ranks: list[int]) -> list[tuple[int, object] | None]:
    """For every rank r the (key, id) of the row at place r (from 0) of ``keyed`` (key, id) in the order of
    (key, id), null ids first; None where there are r rows or fewer.

    The rows are counted by the upper and then, in the halves that a rank falls into, by the lower half
    of the key. Only rows that share a whole 32-bit key with a cut are ordered by id, and of them one
    row per id reaches the driver: with distinct ids a few at any size.
    """
    upper = keyed.groupBy(F.floor(F.col("key") / HALF).alias("h")).agg(F.count(F.lit(1)).alias("n")).orderBy("h").collect()
    spots = {}
    for r in ranks:
        before = 0
        for row in upper:
            if before + row["n"] > r:
                spots[r] = (row["h"], r - before)
                break
            before += row["n"]
    if not spots:
        return [None] * len(ranks)
    inside = keyed.where(F.floor(F.col("key") / HALF).isin([h for h, _ in spots.values()]))
    lower: dict = {}
    for row in inside.groupBy("key").agg(F.count(F.lit(1)).alias("n")).orderBy("key").collect():
        lower.setdefault(row["key"] // HALF, []).append((row["key"], row["n"]))
    keys = {}
    for r, (h, left) in spots.items():
        for key, n in lower[h]:
            if left < n:
                keys[r] = (key, left)
                break
            left -= n
    rows = keyed.where(F.col("key").isin([k for k, _ in keys.values()])).groupBy("key", "id") \
        .agg(F.count(F.lit(1)).alias("n")).orderBy("key", "id").collect()
    found = {}
    for r, (key, left) in keys.items():
        for row in rows:
            if row["key"] == key:
                if left < row["n"]:
                    found[r] = (key, row["id"])
                    break
                left -= row["n"]
    return [found.get(r) for r in ranks]


def _before(cut: tuple[int, object] | None, key: Column, id_: Column, id_type) -> Column:
    """Whether a row comes before the cut."""
    if cut is None:
        return F.lit(True)
    at = F.lit(cut[1]).cast(id_type)
    earlier = at.isNotNull() & (id_.isNull() | (id_ < at))
    return (key < cut[0]) | ((key == cut[0]) & F.coalesce(earlier, F.lit(False)))


def exact_split(df: DataFrame, id_col: str, test_size: float = C.KNN_TEST_SIZE, seed: int = C.KNN_SEED,
                n_folds: int = C.KNN_FOLDS) -> DataFrame:
    """Adds ``is_test`` (exactly ceil(``test_size`` x rows)) and ``fold`` (0 .. n_folds - 1, of sizes at most one
    apart over the other rows; null for test rows).

    Test rows are the first in the order of ``split_key(seed)``, folds are stretches of the other rows in the
    order of ``split_key(seed + 1)``, so neither depends on order or partitions. Rows of one id fall on the
    same side and into the same fold; sizes are exact for distinct ids and off by at most a repeated
    id's rows otherwise. A null id counts as one id.
    """
    names = ("_key", "_turn")
    id_type = df.schema[id_col].dataType
    rows = df.withColumn(names[0], F.coalesce(split_key(id_col, seed), F.lit(0).cast("long"))) \
        .withColumn(names[1], F.coalesce(split_key(id_col, seed + 1), F.lit(0).cast("long")))
    n = rows.count()
    n_test = min(n, math.ceil(test_size * n))
    id_ = F.col(id_col)
    cut = cut_points(rows.select(F.col(names[0]).alias("key"), id_.alias("id")), [n_test])[0]
    rows = rows.withColumn("is_test", _before(cut, F.col(names[0]), id_, id_type))
    left = rows.where(~F.col("is_test"))
    n_left = left.count()
    starts, at = [], 0
    for f in range(n_folds - 1):
        at += n_left // n_folds + (1 if f < n_left % n_folds else 0)
        starts.append(at)
    cuts = cut_points(left.select(F.col(names[1]).alias("key"), id_.alias("id")), starts)
    fold = F.lit(n_folds - 1)
    for f in reversed(range(n_folds - 1)):
        fold = F.when(_before(cuts[f], F.col(names[1]), id_, id_type), f).otherwise(fold)
    return rows.withColumn("fold", F.when(~F.col("is_test"), fold).cast("int")).drop(*names)
