"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records by a seeded hash into buckets of bounded bytes; pass 2 permutes each
bucket in memory (Fisher-Yates) and writes it. The buckets in turn are one uniform random
permutation of all records; shard s of S holds its places from s n / S to (s + 1) n / S, so
row counts differ by at most one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custseg.llm.common import running_before
from custseg.session import materialise

SHARDS = 24
SEED = 20_240
#: Bytes of text (plus 8 a row) of a bucket on average; a task holds one bucket at a time, twice. A larger
#: bucket saves buckets (one row of offsets each): 256 MB suits 100 TB.
BUCKET_BYTES = 16 << 20
#: Shuffle partitions of the scatter at most; a partition then holds several buckets, one after the other.
MOST_PARTITIONS = 1 << 15


def fisher_yates(n: int, seed: int, bucket: int):
    """A uniform permutation of ``n`` places for ``bucket`` (numpy's shuffle is Fisher and Yates's)."""
    import numpy as np
    order = np.arange(n)
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
    return order


def scattered(docs: DataFrame, buckets: int, seed: int = SEED) -> DataFrame:
    """Pass 1: ``row, uid, bucket`` for every row of ``docs``.

    The bucket hashes the row's content and its number. Rows are sorted by content within their
    partition before they are numbered, so that a task that runs again after a lost executor numbers
    them alike (rows of equal content are interchangeable) and repeated rows still spread.
    """
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    return (docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                        F.xxhash64(*[docs[c] for c in hashed]).alias("content"))
            .sortWithinPartitions("content")
            .select("row", F.monotonically_increasing_id().alias("uid"), "content")
            .select("row", "uid", F.pmod(F.xxhash64(F.lit(seed), "content", "uid"), F.lit(buckets)).alias("bucket")))


def shuffled(docs: DataFrame, text_col: str = "text", shards: int = SHARDS, seed: int = SEED,
             bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``row, bucket, place, position, shard, slot`` for every row of ``docs``, written once: ``place`` is
    the order inside the bucket, ``position`` that in the whole permutation, ``slot`` that in the shard.

    Null texts are rows of 8 bytes; null or repeated identifiers and repeated rows count one by one; a
    text above ``bucket_bytes`` makes its bucket larger by itself. With fewer rows than shards some
    shards are empty; an empty table gives no rows. Row columns may have any name. The same table
    read in the same partitions gives the same order.
    """
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 8).alias("bytes")).first()
    buckets = max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    rows = scattered(docs, buckets, seed)
    if buckets > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        rows = rows.repartition(min(buckets, MOST_PARTITIONS), "bucket")

    def permute(key, records):
        import pyarrow as pa
        import pyarrow.compute as pc
        bucket = key[0].as_py()
        # places are drawn for the records in order of their numbers, not in order of arrival
        by_uid = pc.sort_indices(records.column("uid"))
        out = records.take(by_uid.take(pa.array(fisher_yates(records.num_rows, seed, bucket))))
        return pa.table([out.column("row"), out.column("bucket"), pa.array(range(out.num_rows), pa.int64())],
                        names=["row", "bucket", "place"])

    schema = T.StructType([rows.schema["row"], T.StructField("bucket", T.LongType()), T.StructField("place", T.LongType())])
    written = materialise(rows.groupBy("bucket").applyInArrow(permute, schema), "shuffled_buckets")
    counts = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    # one row per bucket; written, so that Spark knows its size before it plans the join
    offsets = materialise(running_before(counts, "bucket", {"before": "n"}).select("bucket", "before"), "shuffle_offsets")
    n = max(1, total["n"])
    position = F.col("before") + F.col("place")
    out = written.join(offsets, "bucket").withColumn("position", position).drop("before") \
        .withColumn("shard", F.expr(f"cast(position * {shards} div {n} AS int)"))
    return out.select("row", "bucket", "place", "position", "shard",
                      F.expr(f"position - (shard * {n}L + {shards - 1}) div {shards}").alias("slot"))


def write_shards(rows: DataFrame, path: str) -> None:
    """The records of ``shuffled`` as Parquet folders ``shard=0 ...`` of ``slot`` and the struct ``row``; a
    file holds a stretch of a shard in order."""
    rows.select("shard", "slot", "row").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digest(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per record of ``shuffled``: identifier, size and checksum of the shuffled text, its place."""
    text = F.col(f"row.{text_col}")
    return rows.select(
        F.col(f"row.{id_col}").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "bucket", "place")
