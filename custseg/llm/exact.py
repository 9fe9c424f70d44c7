"""Exact deduplication by content sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custseg.llm.common import one_space
from custseg.session import materialise

#: A text that holds more than 1/HOT_PARTS of all rows is dealt out over SALTS sub-groups.
#: At most HOT_PARTS texts can be that frequent, which bounds everything broadcast here.
HOT_PARTS = 512
SALTS = 64
#: Characters of the text that a range splitter holds; splitters travel through the driver.
SPLITTER_CHARS = 16


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    carry: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256`` and, with
    ``carry``, the whole input row as the struct ``row``.

    Content sort: Spark's range partitioner samples splitters over (leading characters,
    content hash, salt); each range is sorted externally by the whole normalised text and the
    identifier, so equal texts are adjacent, and the window compares whole neighbouring texts.
    The first row of a run has the smallest identifier. A splitter needs a bounded key: whole
    texts as splitters would put a sample of the corpus on the driver, leading characters alone
    would leave all texts under one licence header in one range.

    Texts that hold more than 1/512 of all rows are salted by identifier; each salted run yields
    its head, and the at most 512 x 64 heads are compared again by whole text.

    Null text counts as empty; texts that differ only in kinds or lengths of white-space runs are
    equal. Of rows with the same text and the same identifier exactly one is kept. Null
    identifiers sort last: one stays only if its group has no other. An empty table gives no
    rows. Input columns of any other name are ignored or carried in ``row``.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), one_space(F.col(text_col)).alias("norm"),
                       *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []))
    rows = rows.withColumn("hash", F.xxhash64("norm"))
    hot = (rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") * HOT_PARTS > F.lit(docs.count()))
           .select("hash", F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)) + 1).otherwise(F.lit(0))
    dealt = (rows.join(F.broadcast(hot), "hash", "left")
             .withColumn("salt", salt).drop("hot")
             .withColumn("lead", F.substring("norm", 1, SPLITTER_CHARS))
             .repartitionByRange("lead", "hash", "salt"))
    run = Window.partitionBy("lead", "hash", "salt", "norm")
    order = run.orderBy(F.col("doc_id").asc_nulls_last())
    rank = F.row_number().over(order)
    # written once: the heads of salted runs are read back from it instead of sorting twice
    ranked = materialise(dealt.select(
        "doc_id", "salt", *(["row"] if carry else []), rank.alias("rank"),
        F.first("doc_id").over(order).alias("run_id"),
        F.count(F.lit(1)).over(run).alias("run_size"),
        F.sha2("norm", 256).alias("text_sha256"),
        F.when((F.col("salt") > 0) & (rank == 1), F.col("norm")).alias("head")), "exact_runs")
    heads = (ranked.filter(F.col("head").isNotNull())
             .groupBy("head")
             .agg(F.min(F.struct(F.col("run_id").isNull().alias("is_null"), "run_id", "salt")).alias("first"),
                  F.sum("run_size").alias("hot_size"), F.first("text_sha256").alias("text_sha256"))
             .select("text_sha256", F.lit(True).alias("hot"), "hot_size",
                     F.col("first.run_id").alias("hot_id"), F.col("first.salt").alias("hot_salt")))
    merged = ranked.join(F.broadcast(heads), "text_sha256", "left")
    return merged.select(
        "doc_id",
        F.when(F.col("hot"), F.col("hot_id")).otherwise(F.col("run_id")).alias("keep_id"),
        F.coalesce("hot_size", "run_size").alias("group_size"),
        ((F.col("rank") == 1) & (F.coalesce("hot_salt", "salt") == F.col("salt"))).alias("kept"),
        "text_sha256", *(["row"] if carry else []))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``mark_duplicates`` keeps, with the columns of ``docs``."""
    return mark_duplicates(docs, id_col, text_col, carry=True).filter("kept").select("row.*")
