"""Clustering: K-Means, centre assignment, quality metrics, ordering.

Summaries with k rows (centres, per-cluster medians, per-cluster spreads) are small by
construction; everything with one row per customer stays in Spark.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.quantiles import exact_quantiles
from ..session import materialise
from .silhouette import silhouette


def sq_distance(features: list[str], centre: list[float]):
    acc = None
    for f, c in zip(features, centre):
        t = (F.col(f) - F.lit(float(c))) * (F.col(f) - F.lit(float(c)))
        acc = t if acc is None else acc + t
    return acc


def assign_clusters(df: DataFrame, features: list[str], centres: list[list[float]],
                    out_col: str = "cluster") -> DataFrame:
    """Nearest centre by squared Euclidean distance; ties -> smallest cluster index.
    Centres are literals: a pure projection, no join."""
    d = [f"_d{i}" for i in range(len(centres))]
    out = df.select("*", *[sq_distance(features, c).alias(n) for n, c in zip(d, centres)])
    best = F.least(*[F.col(n) for n in d]) if len(d) > 1 else F.col(d[0])
    pick = None
    for i in reversed(range(len(d))):
        pick = F.lit(i) if pick is None else F.when(F.col(d[i]) == best, F.lit(i)).otherwise(pick)
    return out.withColumn(out_col, pick.cast("int")).drop(*d)


def first_rows_as_centres(df: DataFrame, features: list[str], k: int, order_col: str) -> list[list[float]]:
    """k data rows (smallest ``order_col``) as deterministic initial centres (k-row collect)."""
    rows = df.orderBy(order_col).limit(k).select(*features).collect()
    return [[float(r[f]) for f in features] for r in rows]


def centres_of(assigned: DataFrame, features: list[str], label_col: str = "cluster") -> DataFrame:
    """Mean of the members of each cluster -> (cluster, *features)."""
    return assigned.groupBy(label_col).agg(*[F.avg(f).alias(f) for f in features])


def lloyd_step(df: DataFrame, features: list[str], centres: list[list[float]]) -> DataFrame:
    """One Lloyd iteration: assign to the nearest centre, return the new centres."""
    return centres_of(assign_clusters(df, features, centres), features)


def _row_blocks(batches, features: list[str]):
    for batch in batches:
        x = batch[features].to_numpy(np.float64)
        for at in range(0, len(x), 65_536):
            yield x[at:at + 65_536]


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, summed feature by feature."""
    out = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        d = x[:, j:j + 1] - centres[:, j][None, :]
        out += d * d
    return out


def farthest_first_centres(df: DataFrame, features: list[str], k: int) -> list[list[float]]:
    """k data rows as deterministic initial centres: the one nearest to the mean (rounded to 9
    digits), then, again and again, the one farthest from all chosen so far; ties go to the smaller
    feature values. One pass per centre; the first centres do not depend on ``k``."""
    mean = df.agg(*[F.round(F.avg(f), 9).alias(f) for f in features]).first()
    if mean[0] is None:
        return []
    chosen: list[list[float]] = []
    schema = "d double, " + ", ".join(f"x{j} double" for j in range(len(features)))
    while len(chosen) < k:
        centres = np.array(chosen or [[float(v) for v in mean]])
        sign = -1.0 if chosen else 1.0

        def best(batches, centres=centres, sign=sign):
            top = None
            for x in _row_blocks(batches, features):
                d = sign * _squared(x, centres).min(1)
                at = np.lexsort((*x.T[::-1], d))[0]
                row = (d[at], *x[at])
                top = row if top is None else min(top, row)
            if top is not None:
                yield pd.DataFrame([top], columns=["d", *[f"x{j}" for j in range(len(features))]])

        found = df.select(*features).mapInPandas(best, schema)
        row = found.agg(F.min(F.struct(*found.columns)).alias("m")).first()["m"]
        chosen.append([float(v) for v in list(row)[1:]])
    return chosen


#: Passes of the parallel seeding, rows drawn per pass as a multiple of k, seed of its priorities.
SEED_PASSES, SEED_OVERSAMPLING, SEED = 4, 2, 42


def _uniform(h: np.ndarray, turn: int) -> np.ndarray:
    """A number in (0, 1) from a row's 64-bit hash and the pass (splitmix64)."""
    z = h.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53) + 2.0 ** -54


def _recluster(x: np.ndarray, w: np.ndarray, ks: list[int]) -> dict[int, list[list[float]]]:
    """For each k centres of the few weighted rows ``x``: greedily the row that lowers the weighted squared
    error most (ties to the earlier row), then Lloyd's rounds over the weighted rows."""
    apart = _squared(x, x)
    chosen: list[int] = []
    left = np.full(len(x), np.inf)
    for _ in range(min(max(ks), len(x))):
        cost = (np.minimum(left[None], apart) * w[None]).sum(1)
        cost[chosen] = np.inf
        chosen.append(int(cost.argmin()))
        left = np.minimum(left, apart[chosen[-1]])
    out = {}
    for k in ks:
        c = x[chosen[:k]].copy()
        for _ in range(100):
            at = _squared(x, c).argmin(1)
            size = np.bincount(at, w, len(c))
            new = np.column_stack([np.bincount(at, w * x[:, j], len(c)) for j in range(x.shape[1])])
            new = np.where(size[:, None] > 0, new / np.maximum(size, 1e-300)[:, None], c)
            if (new == c).all():
                break
            c = new
        out[k] = [*c.tolist(), *[c[0].tolist()] * (k - len(c))]
    return out


def parallel_centres(df: DataFrame, features: list[str], ks: list[int], passes: int = SEED_PASSES,
                     oversampling: int = SEED_OVERSAMPLING, seed: int = SEED) -> dict[int, list[list[float]]]:
    """Initial centres for every k by k-means|| (Bahmani et al. 2012): a first row, then ``passes`` times
    ``oversampling`` x k rows drawn with weights squared distance to those drawn before, then a weighted
    reclustering of the few drawn rows, one pass for all k.

    A pass draws without replacement by priorities -ln(u) / (count x squared distance), u hashed from the
    values (Efraimidis and Spirakis): the smallest ones of every task, then of all. Equal rows are one row
    with a count. So the centres depend on the values alone, not on order or partitions; with fewer
    distinct rows than k the first centre fills up. Whole rows only; an empty table gives no centres.
    """
    x = [F.col(f).cast("double") for f in features]
    names = [f"x{j}" for j in range(len(features))]
    places = df.select(*[(v + 0.0).alias(n) for v, n in zip(x, names)]).dropna().groupBy(*names) \
        .agg(F.count(F.lit(1)).cast("double").alias("w"))
    places = materialise(places.withColumn("h", F.xxhash64(F.lit(seed), *names)), "seed_places")
    schema = "key double, " + ", ".join(f"{n} double" for n in names)

    def draw(centres: np.ndarray, turn: int, n: int) -> list:
        def smallest(batches):
            top = np.empty((0, len(names) + 1))
            for batch in batches:
                rows = batch[names].to_numpy(np.float64)
                weight = batch["w"].to_numpy()
                if len(centres):
                    weight = weight * _squared(rows, centres).min(1)
                real = weight > 0
                key = -np.log(_uniform(batch["h"].to_numpy()[real], turn)) / weight[real]
                top = np.vstack([top, np.column_stack([key, rows[real]])])
                top = top[np.lexsort((*top.T[:0:-1], top[:, 0]))][:n]
            yield pd.DataFrame(top, columns=["key", *names])

        found = places.mapInPandas(smallest, schema).orderBy("key", *names).limit(n).collect()
        return [[r[c] for c in names] for r in found]

    drawn = draw(np.empty((0, len(names))), 0, 1)
    if not drawn:
        return {}
    for turn in range(1, passes + 1):
        drawn += draw(np.array(drawn), turn, oversampling * max(ks))
    centres = np.array(drawn)

    def count(batches):
        total = np.zeros(len(centres))
        for batch in batches:
            at = _squared(batch[names].to_numpy(np.float64), centres).argmin(1)
            total += np.bincount(at, batch["w"].to_numpy(), len(centres))
        yield pd.DataFrame({"i": np.arange(len(total)), "w": total})

    weight = np.zeros(len(centres))
    for r in places.mapInPandas(count, "i int, w double").groupBy("i").agg(F.sum("w").alias("w")).collect():
        weight[r["i"]] = r["w"]
    return _recluster(centres, weight, list(ks))


def initial_centres(df: DataFrame, features: list[str], ks: list[int], init: str) -> dict[int, list[list[float]]]:
    """Centres for every k: ``"parallel"`` (a fixed number of passes) or ``"farthest"`` (one pass per centre);
    empty without rows."""
    if init == "parallel":
        return parallel_centres(df, features, ks)
    if init != "farthest":
        raise ValueError("init must be 'parallel' or 'farthest'")
    start = farthest_first_centres(df, features, max(ks))
    return {k: start[:k] for k in ks} if start else {}


def lloyd(df: DataFrame, features: list[str], starts: dict[int, list[list[float]]], max_iter: int, tol: float
          ) -> tuple[dict[int, list[list[float]]], dict[int, float]]:
    """Lloyd's iterations from each set of ``starts`` (by k), all sets in one job per round: every task
    sums its rows per nearest centre, only those sums are shuffled. A set ends when its centres move
    by no more than ``tol`` times the mean variance (squared); an empty cluster keeps its centre.
    Sets that ``max_iter`` rounds do not end are named in a warning.
    -> (centres, sum of squared errors) by k. Independent of partitioning but for float rounding."""
    stats = df.agg(*[F.var_pop(f).alias(f) for f in features]).first()
    limit = tol * float(np.mean([v or 0.0 for v in stats]))
    centres = {k: np.array(c) for k, c in starts.items()}
    open_ = set(centres)
    names = [f"x{j}" for j in range(len(features))]

    def round_(now: dict[int, np.ndarray]) -> list:
        def sums(batches):
            total = {k: np.zeros((len(c), len(features) + 2)) for k, c in now.items()}
            for x in _row_blocks(batches, features):
                for k, c in now.items():
                    d = _squared(x, c)
                    at = d.argmin(1)
                    np.add.at(total[k], at, np.column_stack([x, np.ones(len(x)), d[np.arange(len(x)), at]]))
            yield pd.concat([pd.DataFrame(t, columns=[*names, "n", "sse"]).assign(k=k, cluster=range(len(t)))
                             for k, t in total.items()])

        parts = df.select(*features).mapInPandas(
            sums, ", ".join(f"{n} double" for n in names) + ", n double, sse double, k int, cluster int")
        return parts.groupBy("k", "cluster").agg(*[F.sum(n).alias(n) for n in [*names, "n", "sse"]]).collect()

    for _ in range(max_iter):
        if not open_:
            break
        moved = {k: centres[k].copy() for k in open_}
        for r in round_({k: centres[k] for k in open_}):
            if r["n"] > 0:
                moved[r["k"]][r["cluster"]] = [r[n] / r["n"] for n in names]
        for k, c in moved.items():
            shift = float(((c - centres[k]) ** 2).sum())
            centres[k] = c
            if shift <= limit:
                open_.discard(k)
    if open_:
        warnings.warn(f"K-Means did not converge in {max_iter} rounds for k = {sorted(open_)}", stacklevel=2)
    sse = dict.fromkeys(centres, 0.0)
    for r in round_(centres) if centres else []:
        sse[r["k"]] += r["sse"]
    return {k: c.tolist() for k, c in centres.items()}, sse


@dataclass
class KMeansModel:
    centres: list[list[float]]
    sse: float


def kmeans_fit(df: DataFrame, features: list[str], k: int = C.KMEANS_K, max_iter: int = C.KMEANS_MAX_ITER,
               tol: float = C.KMEANS_TOL, out_col: str = "cluster", init: str = "parallel"
               ) -> tuple[KMeansModel, DataFrame]:
    """K-Means from deterministic ``initial_centres`` -> (model, labelled df). Labels compare with a seeded
    single-machine fit by quality, not row by row. An empty table gets null labels."""
    start = initial_centres(df, features, [k], init)
    if not start:
        return KMeansModel([], 0.0), df.withColumn(out_col, F.lit(None).cast("int"))
    centres, sse = lloyd(df, features, start, max_iter, tol)
    return KMeansModel(centres[k], sse[k]), assign_clusters(df, features, centres[k], out_col)


def kmeans_sweep(df: DataFrame, features: list[str], ks=C.KMEANS_SWEEP, max_iter: int = C.KMEANS_MAX_ITER,
                 tol: float = C.KMEANS_TOL, init: str = "parallel", tolerance: float | None = None) -> DataFrame:
    """(k, sse, silhouette_sq) for each k, all fits side by side over one written table. With a ``tolerance``
    the Euclidean silhouette of every k > 1, certified to it, is the column ``silhouette``."""
    base = materialise(df.select(*[F.col(f).cast("double").alias(f) for f in features]), "kmeans_rows")
    schema = "k int, sse double, silhouette_sq double" + (", silhouette double" if tolerance else "")
    start = initial_centres(base, features, list(ks), init)
    if not start:
        return df.sparkSession.createDataFrame([], schema)
    centres, sse = lloyd(base, features, start, max_iter, tol)
    quality = _silhouettes(base, features, centres)
    rows = [(k, sse[k], quality.get(k)) for k in ks]
    if tolerance:
        rows = [(*row, silhouette(assign_clusters(base, features, centres[row[0]]), features, tolerance=tolerance).first()[0]
                 if row[0] > 1 else None) for row in rows]
    return df.sparkSession.createDataFrame(rows, schema)


def _silhouettes(df: DataFrame, features: list[str], centres: dict[int, list[list[float]]]) -> dict[int, float]:
    """Mean silhouette on squared distances of the nearest-centre labels of each set of centres."""
    sets = {k: np.array(c) for k, c in centres.items() if len(c) > 1}
    width = len(features)
    names = [f"x{j}" for j in range(width)]

    def sums(batches):
        total = {k: np.zeros((len(c), width + 2)) for k, c in sets.items()}
        for x in _row_blocks(batches, features):
            for k, c in sets.items():
                np.add.at(total[k], _squared(x, c).argmin(1), np.column_stack([x, np.ones(len(x)), (x * x).sum(1)]))
        for k, t in total.items():
            yield pd.DataFrame(t, columns=[*names, "n", "q"]).assign(k=k, cluster=range(len(t)))

    known = df.select(*features).mapInPandas(
        sums, ", ".join(f"{n} double" for n in names) + ", n double, q double, k int, cluster int") \
        .groupBy("k", "cluster").agg(*[F.sum(n).alias(n) for n in [*names, "n", "q"]]).collect()
    stats = {k: np.zeros((len(c), width + 2)) for k, c in sets.items()}
    for r in known:
        stats[r["k"]][r["cluster"]] = [*[r[n] for n in names], r["n"], r["q"]]

    def score(batches):
        total = dict.fromkeys(sets, 0.0)
        for x in _row_blocks(batches, features):
            for k, c in sets.items():
                own = _squared(x, c).argmin(1)
                n, q = stats[k][:, width], stats[k][:, width + 1]
                far = (x * x).sum(1)[:, None] * n - 2 * (x @ stats[k][:, :width].T) + q
                rows = np.arange(len(x))
                a = far[rows, own] / np.maximum(n[own] - 1, 1)
                other = np.where(n > 0, far / np.maximum(n, 1), np.inf)
                other[rows, own] = np.inf
                b = other.min(1)
                top = np.maximum(a, b)
                fine = (n[own] > 1) & np.isfinite(b) & (top > 0)
                total[k] += float(np.where(fine, (b - a) / np.where(fine, top, 1.0), 0.0).sum())
        yield pd.DataFrame({"k": list(total), "s": list(total.values())})

    got = df.select(*features).mapInPandas(score, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    return {r["k"]: float(r["s"] / max(1.0, stats[r["k"]][:, width].sum())) for r in got}


def davies_bouldin(labelled: DataFrame, features: list[str], label_col: str = "cluster") -> DataFrame:
    """Davies-Bouldin index -> one row (davies_bouldin). s_i = mean distance of members to
    their centre; index = mean_i max_{j != i} (s_i + s_j) / |c_i - c_j|; 0 when all spreads
    or all centre distances are 0. Linear in rows; the k x k step works on k rows."""
    cen = centres_of(labelled, features, label_col)
    cen_cols = [F.col(f).alias("_c_" + f) for f in features]
    joined = labelled.join(F.broadcast(cen.select(label_col, *cen_cols)), label_col)
    dist = F.sqrt(sum(((F.col(f) - F.col("_c_" + f)) ** 2 for f in features), F.lit(0.0)))
    spread = joined.groupBy(label_col).agg(F.avg(dist).alias("s"))
    per = spread.join(cen, label_col)
    a = per.select(*[F.col(c).alias("a_" + c) for c in per.columns])
    b = per.select(*[F.col(c).alias("b_" + c) for c in per.columns])
    cd = F.sqrt(sum(((F.col("a_" + f) - F.col("b_" + f)) ** 2 for f in features), F.lit(0.0)))
    pairs = (a.join(b, F.col("a_" + label_col) != F.col("b_" + label_col))
             .select(F.col("a_" + label_col).alias("i"),
                     F.when(cd == 0, F.lit(0.0))
                      .otherwise((F.col("a_s") + F.col("b_s")) / cd).alias("r")))
    score = pairs.groupBy("i").agg(F.max("r").alias("r")).agg(F.avg("r").alias("davies_bouldin"))
    return score.select(F.coalesce("davies_bouldin", F.lit(0.0)).alias("davies_bouldin"))


def silhouette_squared(labelled: DataFrame, features: list[str], label_col: str = "cluster") -> DataFrame:
    """Mean silhouette on squared Euclidean distances -> one row (silhouette_sq).

    a(i) = mean squared distance to the other members of i's cluster, b(i) = smallest mean squared
    distance to another cluster, s(i) = (b - a) / max(a, b), 0 for a singleton cluster. Linear: a
    cluster's count, sums and sum of squares (k rows) give every row's means; null for one cluster.
    """
    norm = sum((F.col(f) * F.col(f) for f in features), F.lit(0.0))
    known = labelled.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(
        F.count(F.lit(1)).alias("n"), F.sum(norm).alias("q"), *[F.sum(f).alias(f"s_{f}") for f in features]).collect()
    a, others = F.lit(None).cast("double"), []
    single = F.lit(False)
    for r in known:
        own = F.col(label_col) == r[label_col]
        far = norm * float(r["n"]) - 2.0 * sum((F.col(f) * float(r[f"s_{f}"]) for f in features), F.lit(0.0)) + float(r["q"])
        if r["n"] > 1:
            a = F.when(own, far / float(r["n"] - 1)).otherwise(a)
        else:
            single = single | own
        others.append(F.when(~own, far / float(r["n"])))
    if len(known) < 2:
        return labelled.agg(F.lit(None).cast("double").alias("silhouette_sq"))
    rows = labelled.where(F.col(label_col).isNotNull()).select(a.alias("a"), F.least(*others).alias("b"), single.alias("one"))
    top = F.greatest("a", "b")
    s = F.when(F.col("one") | (top <= 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / top)
    return rows.agg(F.avg(F.coalesce(s, F.lit(0.0))).alias("silhouette_sq"))


def order_clusters(labelled: DataFrame, feature_sort: dict[str, bool] = C.CLUSTER_FEATURE_SORT,
                   label_col: str = "cluster", mode: str = "monetary") -> DataFrame:
    """Renumber clusters by their per-cluster medians.

    For each feature in order, clusters are ranked by median (ascending when True) and the
    rank position is added to an ``rfm_score``. ``mode='monetary'`` numbers the clusters by
    the order of the *last* sort (what the source pipeline outputs); ``mode='rfm_score'``
    numbers them by the score (the stated intent). Ties break by cluster id. The k-row
    ranking runs on the median table only; rows get the new id by a broadcast join.
    """
    feats = list(feature_sort)
    each = exact_quantiles(labelled, feats, [0.5], by=label_col)
    med = each.groupBy(label_col).agg(*[F.max(F.when(F.col("feature") == f, F.col("q")[0])).alias(f) for f in feats])
    score = F.lit(0)
    for f in feats:
        o = F.col(f).asc() if feature_sort[f] else F.col(f).desc()
        score = score + (F.row_number().over(Window.orderBy(o, F.col(label_col))) - 1)
    ranked = med.withColumn("rfm_score", score)
    if mode == "monetary":
        last = feats[-1]
        o = F.col(last).asc() if feature_sort[last] else F.col(last).desc()
        new = F.row_number().over(Window.orderBy(o, F.col(label_col))) - 1
    elif mode == "rfm_score":
        new = F.row_number().over(Window.orderBy(F.col("rfm_score"), F.col(label_col))) - 1
    else:
        raise ValueError("mode must be 'monetary' or 'rfm_score'")
    mapping = ranked.select(label_col, new.cast("int").alias("_new"))
    return (labelled.join(F.broadcast(mapping), label_col)
            .drop(label_col).withColumnRenamed("_new", label_col))


def model_centres(spark: SparkSession, model: KMeansModel, features: list[str]) -> DataFrame:
    """Centres of a fitted model as rows (cluster, feature, value): k x features rows."""
    rows = [(i, f, float(v)) for i, c in enumerate(model.centres) for f, v in zip(features, c)]
    return spark.createDataFrame(rows, "cluster int, feature string, value double")
