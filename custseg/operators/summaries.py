"""Summary tables behind the distribution plots: histogram, density curve, box statistics.

Only the numbers are built (the drawing is left to any plotting tool). Each is one or two
aggregate passes; per-row work is JVM Column arithmetic.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles, quantile_lists


def _stats(df: DataFrame, col: str):
    x = F.col(col).cast("double")
    return df.where(x.isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"),
                                       F.stddev_samp(x).alias("sd")).first()


def auto_bins(n: int, lo: float, hi: float, q1: float, q3: float) -> int:
    """Bin count of numpy's 'auto' rule: the smaller width of Freedman-Diaconis and
    Sturges (Sturges alone when the IQR is 0)."""
    rng = hi - lo
    if n == 0 or rng == 0:
        return 1
    sturges = rng / (math.log2(n) + 1.0)
    fd = 2.0 * (q3 - q1) * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    return int(math.ceil(rng / width)) if width > 0 else 1


def bin_edges(lo: float, hi: float, bins: int) -> list[float]:
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    return [float(v) for v in np.linspace(lo, hi, bins + 1)]


def histogram(df: DataFrame, col: str, bins: int | None = None) -> DataFrame:
    """(bin, lower, upper, count) for every bin (empty bins included); equal-width bins over
    [min, max], the last bin closed, other bins half-open."""
    st = _stats(df, col)
    n, lo, hi = st["n"], st["lo"], st["hi"]
    if bins is None:
        bins = auto_bins(n, lo, hi, *quantile_lists(df, [col], [0.25, 0.75])[col][1]) if n else 1
    edges = bin_edges(lo if n else 0.0, hi if n else 1.0, bins)
    e = F.array(*[F.lit(v) for v in edges])
    x = F.col(col).cast("double")
    norm = bins / (edges[-1] - edges[0])
    i0 = F.least(F.floor((x - F.lit(edges[0])) * F.lit(norm)).cast("int"), F.lit(bins - 1))
    # correct floating-point misplacement against the exact edges
    i1 = (F.when(x < F.element_at(e, i0 + 1), i0 - 1)
          .when((x >= F.element_at(e, i0 + 2)) & (i0 != bins - 1), i0 + 1)
          .otherwise(i0))
    counts = (df.where(x.isNotNull()).select(i1.alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    lower = F.element_at(e, F.col("bin") + 1)
    upper = F.element_at(e, F.col("bin") + 2)
    return (all_bins.join(counts, "bin", "left")
            .select("bin", lower.alias("lower"), upper.alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def density(df: DataFrame, col: str, gridsize: int = 200, cut: float = 0.0) -> DataFrame:
    """Gaussian kernel density on a grid -> (i, x, density); Scott's bandwidth
    h = sd * n^(-1/5) (sample sd). Exact: every row contributes to every grid point, summed per
    Arrow batch before anything is shuffled. Empty for a column without values or spread."""
    st = _stats(df, col)
    n, lo, hi = st["n"], st["lo"], st["hi"]
    h = (st["sd"] or 0.0) * n ** (-0.2) if n else 0.0
    if not h > 0:
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    grid = np.linspace(lo - cut * h, hi + cut * h, gridsize)

    def sums(batches):
        total = np.zeros(gridsize)
        for batch in batches:
            x = batch["x"].to_numpy()
            for at in range(0, len(x), 2048):
                z = (grid[:, None] - x[None, at:at + 2048]) / h
                total += np.exp(-0.5 * z * z).sum(1)
        yield pd.DataFrame({"i": np.arange(gridsize), "s": total})

    x = F.col(col).cast("double")
    parts = df.where(x.isNotNull()).select(x.alias("x")).mapInPandas(sums, "i int, s double")
    points = F.array(*[F.lit(float(g)) for g in grid])
    return parts.groupBy("i").agg(F.sum("s").alias("s")).select(
        "i", F.element_at(points, F.col("i") + 1).alias("x"),
        (F.col("s") * F.lit(1.0 / (n * h * math.sqrt(2 * math.pi)))).alias("density"))


def box_stats(df: DataFrame, col: str, by: str | None = None, whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest data within 1.5 IQR of the box) and outlier counts,
    optionally per group. Two aggregates: quartiles, then whiskers against them."""
    x = F.col(col).cast("double")
    keys = [by] if by else ["_all"]
    base = df.where(x.isNotNull()).select(*([by] if by else [F.lit(0).alias("_all")]), x.alias("_x"))
    q = exact_quantiles(base, ["_x"], [0.25, 0.5, 0.75], by=keys[0])
    q = q.select(F.col(keys[0]).alias("_group"), "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                 F.col("q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_b = F.col("q1") - whis * F.col("iqr")
    hi_b = F.col("q3") + whis * F.col("iqr")
    # one row per group; AQE broadcasts it when the group count is small
    j = base.join(q, F.col(keys[0]).eqNullSafe(F.col("_group"))).drop("_group")
    w = j.groupBy(*keys, "n", "q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col("_x") >= lo_b, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(F.col("_x") <= hi_b, F.col("_x"))).alias("whisker_hi"),
        F.sum(((F.col("_x") < lo_b) | (F.col("_x") > hi_b)).cast("long")).alias("n_outliers"))
    return w if by else w.drop("_all")
