"""Document quality: a text classifier combined with host and path evidence by empirical Bayes."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custseg.llm.toxicity import fold, logistic
from custseg.session import materialise

#: Labelled rows the classifier is fitted on at most.
TRAIN_ROWS = 20_000
#: Weight of a site's posterior odds beside the document's own, and bounds of a prior's strength.
SITE_WEIGHT, WEAKEST, STRONGEST = 1.0, 1.0, 1e6
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_CASE = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def text_features(text: str | None) -> list[float]:
    """What a whole text's form tells: shares of odd characters, capitals and digits, repetition
    of words, word pairs and lines, lengths. An empty text gives zeros and a flag."""
    if not text or text.isspace():
        return [0.0] * 11 + [1.0]
    words = WORD.findall(text)
    n, size = len(words), len(text)
    letters = sum(map(str.isalpha, words))
    counted = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip()]
    odd = sum(map(text.count, "#$%&*|!<>{}[]=_~^@\\"))
    bare = sum(map(text.count, "0123456789"))
    capitals = len(LETTER_CASE.findall(text))
    return [odd / n, capitals / size * 10, bare / n, letters / n, len(counted) / n,
            counted.most_common(1)[0][1] / n, pairs / max(n - 1, 1), len(set(lines)) / len(lines),
            math.log1p(n), size / n / 10, math.log1p(n) * (len(counted) / n), 0.0]


def _features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([text_features(t) for t in batch])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights (bias first; features standardised inside) of a logistic classifier on at most ``train_rows``
    labelled rows that are not held out, smallest hash of the identifier first."""
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good"))
              .filter(F.col("good").isNotNull() & (fold(F.col("id")) != 0))
              .groupBy("id").agg(F.min("good").alias("good")).orderBy(F.xxhash64("id"), "id").limit(train_rows))
    feature = F.pandas_udf("array<double>")(_features)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id") \
        .select("id", "good", feature("text").alias("f")).dropDuplicates(["id"]).toPandas().sort_values("id")
    if rows["good"].nunique() < 2:
        return np.array([4.0, -2.0, -1.0, -0.3, 1.0, 1.0, -3.0, 1.0, 1.0, 0.0, 0.0, 0.0, -6.0])
    x = np.array(rows["f"].tolist())
    middle, spread = x.mean(0), x.std(0) + 1e-6
    w = logistic((x - middle) / spread, rows["good"].to_numpy(float))
    return np.concatenate([[w[0] - (w[1:] * middle / spread).sum()], w[1:] / spread])


def evidence(text: Column, weights: np.ndarray) -> Column:
    """Log odds of good quality from the text alone."""
    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            x = np.array([text_features(t) for t in batch]).reshape(-1, len(weights) - 1)
            yield pd.Series(np.clip(x @ weights[1:] + weights[0], -12, 12))
    return run(text)


def _strength(groups: DataFrame, mean: Column, prior: Column, n: Column) -> Column:
    """Strength of a beta prior by the method of moments: how far group means spread beyond what
    their sizes explain. Little spread makes a strong prior, which shrinks small groups fully."""
    noise = F.sum(n * prior * (1 - prior) / n) / F.sum(n)
    spread = F.sum(n * (mean - prior) * (mean - prior)) / F.sum(n) - noise
    var = F.sum(n * prior * (1 - prior)) / F.sum(n)
    return F.when(spread > 1e-9, F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), var / spread - 1))) \
        .otherwise(F.lit(STRONGEST))


def grade(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """``doc_id, text_score, host_score, path_score, score, held_out, kept`` per input row.

    The classifier's probability is a document's own evidence. Summed over a host and over a path
    within it, probabilities update a beta prior: the host's prior is the global mean, the path's
    prior the host's posterior, each as strong as the spread of the groups warrants, so sparse sites
    shrink to their parents. A document's odds are then moved by the ratio of its path's odds, from all
    other documents of the path, to the global odds. ``kept`` is ``score >= 0.5``.

    All counts cover every row. Only small rows are shuffled, never texts, and group sums are combined
    on the map side, so a hot host costs one row per task. Null text is graded as empty; a null host
    or path is a site of its own; repeated rows count one by one; an empty table gives no rows.
    """
    rows = materialise(docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
        F.col(path_col).cast("string").alias("path"), evidence(F.col(text_col), weights).alias("odds")), "quality_rows")
    p = 1 / (1 + F.exp(-F.col("odds")))
    rows = rows.withColumn("p", p)
    paths = rows.groupBy("host", "path").agg(F.sum("p").alias("good"), F.count(F.lit(1)).alias("n"))
    hosts = paths.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("n").alias("host_n"))
    total = hosts.agg(F.sum("host_good").alias("g"), F.sum("host_n").alias("n")).first()
    base = min(max((total["g"] or 0.5) / (total["n"] or 1), 1e-4), 1 - 1e-4)
    share, prior = F.col("host_good") / F.col("host_n"), F.lit(base)
    strong = hosts.agg(_strength(hosts, share, prior, F.col("host_n")).alias("k")).first()["k"] or STRONGEST
    hosts = hosts.withColumn("host_score", (F.col("host_good") + strong * base) / (F.col("host_n") + strong)) \
        .withColumnRenamed("host", "_host")
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    strong_path = sites.agg(_strength(sites, F.col("good") / F.col("n"), F.col("host_score"), F.col("n")).alias("k")) \
        .first()["k"] or STRONGEST
    sites = materialise(sites.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "good", "n",
                                     "host_score"), "quality_sites")
    same = F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))
    others = (F.col("good") - F.col("p") + strong_path * F.col("host_score")) / (F.col("n") - 1 + strong_path)
    others = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), others))
    moved = F.col("odds") + SITE_WEIGHT * (F.log(others / (1 - others)) - math.log(base / (1 - base)))
    graded = rows.join(sites, same).select("doc_id", F.col("p").alias("text_score"), "host_score",
                                           others.alias("path_score"), (1 / (1 + F.exp(-moved))).alias("score"))
    return graded.withColumn("held_out", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))) \
        .withColumn("kept", F.col("score") >= 0.5)
