"""Filter interaction audit: what every order of five text filters would remove, from 32 states.

Filters (a text is removed by the first filter of an order that it fails):

- A: under 100 words;
- B: distinct words below 80 % of the words (case-sensitive);
- C: over 10 % of the code points are capital letters A-Z;
- D: holds one of the characters ``#$%&*|``;
- E: identical to the text of a smaller identifier anywhere in the table, removed or not.

Null text is empty; a null ``lang`` counts as the empty string. A null identifier is neither smaller
nor larger than another, so its row never fails E; repeated identifiers are rows of their own. Label
rows repeated for one identifier count as one that holds whatever any of them holds. An empty
table has no parts and gives no rows. Input columns of other names are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custseg.llm.common import SPACES

FILTERS = "ABCDE"
LEAST_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
STATES = 1 << len(FILTERS)

CELL = "part string, mask int, n long, good long, toxic long"
STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
         "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_failures(words: Column, text: Column) -> Column:
    """Bits 0 to 3: whether ``text`` with the list of ``words`` fails A, B, C and D."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = [n < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * n,
              100 * capitals > CAPITAL_PERCENT * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failed)), F.lit(0))


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``doc_id, part, mask, text_hash`` of every row: failures of A to D (bits 0 to 3) and the
    SHA-256 of the text, which stands for the text from here on."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    trimmed = F.btrim("text", F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    return text.withColumn("words", words).select(
        "doc_id", "part", text_failures(F.col("words"), F.col("text")).cast("int").alias("mask"),
        F.unhex(F.sha2("text", 256)).alias("text_hash"))


def cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: the rows of ``marked`` per part and set of failed filters, E now
    included, with the numbers of those that ``labels`` (doc_id, quality, toxic) calls good and toxic.

    At most 32 rows per part. Only hashes and identifiers are shuffled. The rows of one text are
    summed per part, labels and identifier first, then per part and labels next to the smallest
    identifier, so a text that a third of all rows hold leaves a few rows per task; the last
    window compares these sums of one text. Rows with a null identifier join nothing and are
    dealt out by their text.
    """
    known = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    ).withColumn("deal", F.lit(0).cast("long"))
    dealt = rows.withColumn("deal", F.when(F.col("doc_id").isNull(), F.xxhash64("text_hash")).otherwise(F.lit(0).cast("long")))
    same = (dealt["doc_id"] == known["label_id"]) & (dealt["deal"] == known["deal"])
    group = ["text_hash", "part", "mask", "good", "toxic"]
    each = dealt.join(known, same, "left").select(
        "doc_id", dealt["deal"], "text_hash", "part", "mask",
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")) \
        .groupBy("doc_id", "deal", *group).agg(F.count(F.lit(1)).alias("n"))
    text = Window.partitionBy("text_hash")
    sums = each.groupBy(*group).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first_id"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
        F.coalesce(F.min_by(F.when(F.col("doc_id").isNotNull(), F.col("n")), "doc_id"), F.lit(0)).alias("firsts"))
    first = F.col("first_id") == F.min("first_id").over(text)
    sums = sums.withColumn("fresh", F.col("unnamed") + F.when(first, F.col("firsts")).otherwise(F.lit(0)))
    split = F.explode(F.array(F.struct(F.col("mask"), F.col("fresh").alias("n")),
                              F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("fresh")).alias("n"))))
    return (sums.select("part", "good", "toxic", split.alias("cell")).filter("cell.n > 0")
            .groupBy("part", F.col("cell.mask").alias("mask"))
            .agg(F.sum("cell.n").alias("n"), F.sum(F.col("cell.n") * F.col("good")).alias("good"),
                 F.sum(F.col("cell.n") * F.col("toxic")).alias("toxic")))


def survivors(masks: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``counts`` (one row per cell) over the cells that pass, for each of the 32 subsets of
    filters: a walk along the Gray code, where neighbouring subsets differ in one filter.

    Every cell keeps the number of active filters that it fails. Switching a filter on takes out
    the cells whose number leaves zero; switching it off brings back those that return to it.
    """
    out = np.zeros((STATES, counts.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)
    running = counts.sum(0)
    out[0] = running
    state = 0
    for step in range(1, STATES):
        bit = (step & -step).bit_length() - 1
        state ^= 1 << bit
        hit = (masks >> bit & 1).astype(bool)
        if state >> bit & 1:
            running = running - counts[hit & (failing == 0)].sum(0)
            failing += hit
        else:
            failing -= hit
            running = running + counts[hit & (failing == 0)].sum(0)
        out[state] = running
    return out


def steps(alive: np.ndarray, orders: list[str] | None = None) -> list[tuple]:
    """``(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of
    every order, as differences of the 32 states ``alive`` (all, good, toxic survivors)."""
    n = len(FILTERS)
    every = STATES - 1
    fails = [int(alive[0, 0] - alive[1 << f, 0]) for f in range(n)]
    alone = [int(alive[every ^ (1 << f), 0] - alive[every, 0]) for f in range(n)]
    # orders in which exactly the filters of a subset come before f: |subset|! (n - 1 - |subset|)!
    shapley = [sum(factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())
                   * int(alive[s, 0] - alive[s | 1 << f, 0]) for s in range(STATES) if not s >> f & 1) for f in range(n)]
    out = []
    for order in orders or ["".join(p) for p in permutations(FILTERS)]:
        state = 0
        for k, letter in enumerate(order, 1):
            f = FILTERS.index(letter)
            lost = alive[state] - alive[state | 1 << f]
            state |= 1 << f
            removed = int(lost[0])
            out.append((order, k, int(alive[state, 0]), removed, fails[f] - removed, alone[f],
                        int(lost[1]), int(lost[2]), shapley[f]))
    return out


def audit(counted: DataFrame) -> DataFrame:
    """One row per part, order and step of ``cells``: 600 per part. A group holds at most 32 cells."""
    names = [c.split(" ")[0] for c in STEPS.split(", ")]

    def walk(cell: pd.DataFrame) -> pd.DataFrame:
        alive = survivors(cell["mask"].to_numpy(np.int64), cell[["n", "good", "toxic"]].to_numpy(np.int64))
        return pd.DataFrame([(cell["part"].iloc[0], *row) for row in steps(alive)], columns=names)

    return counted.groupBy("part").applyInPandas(walk, STEPS)
