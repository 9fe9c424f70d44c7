"""Quantiles of whole columns: exact ones, per group, without gathering a column in one task, and, where
asked for, those of a mergeable sketch with a bounded rank error."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def exact_quantiles(df: DataFrame, cols: list[str], levels: list[float], by: str | None = None) -> DataFrame:
    """``[by,] feature, n, q``: the ``levels`` of each column (linear interpolation) as array ``q``, over its
    non-null values; a column or group without values has no row.

    Distinct values are counted (combined on the map side), range-partitioned and ranked by sums
    per partition plus a running sum inside each; only the rows at the wanted ranks are picked.
    """
    key = [F.col(by).alias("by")] if by else [F.lit(0).alias("by")]
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                                 for c in cols])).alias("v")
    counted = (df.select(*key, values).select("by", "v.feature", "v.value").where(F.col("value").isNotNull())
               .groupBy("by", "feature", "value").agg(F.count(F.lit(1)).alias("c")))
    dealt = materialise(counted.repartitionByRange("by", "feature", "value")
                        .withColumn("part", F.spark_partition_id()), "quantile_values")
    group = ["by", "feature"]
    parts = dealt.groupBy(*group, "part").agg(F.sum("c").alias("size"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*group, "part", "size", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
                         F.sum("size").over(Window.partitionBy(*group)).alias("n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("n") - 1)).alias("at"))
                                 for i, p in enumerate(levels)])).alias("w")
    wanted = parts.select(*group, "part", "before", "size", "n", wanted) \
        .select(*group, "part", "before", "size", "n", "w.i", "w.at",
                F.explode(F.array(F.floor("w.at"), F.ceil("w.at"))).alias("rank")).distinct() \
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("size")))
    inside = Window.partitionBy(*group, "part").orderBy("value")
    ranked = dealt.select(*group, "part", "value", F.col("c"),
                          (F.sum("c").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))).alias("upto"))
    same = [F.col(f"r.{g}").eqNullSafe(F.col(f"w.{g}")) for g in (*group, "part")]
    local = F.col("w.rank") - F.col("w.before")
    found = (ranked.alias("r").join(wanted.alias("w"), same)
             .where((local < F.col("r.upto")) & (local >= F.col("r.upto") - F.col("r.c")))
             .groupBy(*[F.col(f"w.{g}").alias(g) for g in group], "w.n", "w.i", "w.at")
             .agg(F.min("r.value").alias("low"), F.max("r.value").alias("high")))
    point = F.col("low") + F.when(F.col("high") > F.col("low"), (F.col("high") - F.col("low"))
                                  * (F.col("at") - F.floor("at"))).otherwise(F.lit(0.0))
    out = (found.select(*group, "n", "i", point.alias("x")).groupBy(*group, "n")
           .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda v: v["x"]).alias("q")))
    return out.withColumnRenamed("by", by) if by else out.drop("by")


def sketch_quantiles(df: DataFrame, cols: list[str], levels: list[float], error: float
                     ) -> dict[str, tuple[int, list[float]]]:
    """Per column the number of non-null values and, for each level, a value of the column whose rank is
    within ``error`` times that number of the level's. One pass for all columns: every task keeps one
    Greenwald-Khanna summary a column, whose size hangs on ``error`` and not on the rows, and the
    summaries are merged. A column without values is absent."""
    if not 0 < error < 1:
        raise ValueError("the rank error must lie between 0 and 1")
    points = F.array(*[F.lit(float(p)) for p in levels])
    x = [F.col(c).cast("double") for c in cols]
    row = df.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(x)],
                 *[F.percentile_approx(v, points, F.lit(math.ceil(1 / error))).alias(f"q{i}") for i, v in enumerate(x)]).first()
    return {c: (row[f"n{i}"], [float(v) for v in row[f"q{i}"]]) for i, c in enumerate(cols) if row[f"n{i}"]}


def quantile_lists(df: DataFrame, cols: list[str], levels: list[float], approx: float | None = None
                   ) -> dict[str, tuple[int, list[float]]]:
    """Per column the number of values and its quantiles, as the few numbers they are; a column
    without values is absent. Exact unless ``approx`` names a rank error for ``sketch_quantiles``."""
    if approx is not None:
        return sketch_quantiles(df, cols, levels, approx)
    return {r["feature"]: (r["n"], list(r["q"])) for r in exact_quantiles(df, cols, levels).collect()}
