"""Shared Column expressions and small distributed building blocks of the llm operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The white space of every text contract, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def one_space(text: Column) -> Column:
    """``text`` (null: empty) with each run of white space replaced by one space.

    ``translate`` first makes every white-space character a space, so the regex only has to
    find the rare longer runs instead of every word gap.
    """
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.regexp_replace(spaced, " {2,}", " ")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text`` (null: 0)."""
    t = F.trim(one_space(text))
    gaps = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
    return F.when(t == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def running_before(df: DataFrame, index: str, values: dict[str, str], by: tuple[str, ...] = (),
                   width: int = 4096) -> DataFrame:
    """Exclusive running totals of ``values`` (output name -> column) over the integer ``index``
    within ``by``, in two levels: totals per block of ``width`` indexes are summed first, then
    each block on its own. No window holds more than ``width`` rows or 1/width of the indexes.
    """
    block = F.floor(F.col(index) / width).alias("_block")
    sums = df.groupBy(*by, block).agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in values.items()])
    over = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    keys = [*by, "_block"]
    offsets = sums.select(*[F.col(k).alias(f"_key_{k}") for k in keys],
                          *[F.coalesce(F.sum(f"_sum_{k}").over(over), F.lit(0)).alias(f"_off_{k}") for k in values])
    inner = Window.partitionBy(*keys).orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    left = df.withColumn("_block", F.floor(F.col(index) / width))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    joined = left.join(offsets, same, "inner")
    return joined.select(*[c for c in left.columns if c != "_block"], *[
        (F.coalesce(F.sum(v).over(inner), F.lit(0)) + F.col(f"_off_{k}")).alias(k) for k, v in values.items()])
