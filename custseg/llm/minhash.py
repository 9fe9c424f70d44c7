"""Near-duplicate documents by min-max hashing of word shingles, confirmed on full sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custseg.operators.resolve import connected_components
from custseg.session import materialise

#: Shingle length, permutations and values per band. 80 permutations give 160 values in 40 bands
#: of 4: two sets of similarity 0.75 share none of their bands with probability
#: (1 - 0.75^4)^40 < 3e-7 (min and max of a permutation fall into different bands).
SHINGLE, PERMUTATIONS, BAND = 5, 80, 4
#: Shingles hashed at once under all permutations; bounds a task's memory for long texts.
CHUNK = 2_048
#: Pairs of representatives compared in one task.
BLOCK_PAIRS = 2_000


def words_of(text: str | None) -> list[bytes]:
    """Words between white space, A-Z in lower case: exactly what bytes' own methods do."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Distinct shingles of ``words`` as sorted 64-bit hashes; fewer words than ``size`` make one."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        # an order-dependent mix of the word hashes; arithmetic is modulo 2**64
        out = (out ^ one[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def multipliers(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = rng.integers(0, 1 << 32, size=(2, count, 1), dtype=np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def min_max(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum and the maximum of ``sets`` under every permutation x -> a x + b modulo 2**32 of their
    upper halves: ``[min_0 .. min_p, max_0 .. max_p]``."""
    values = (sets >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    high = np.zeros(len(a), np.uint32)
    for at in range(0, len(values), CHUNK):
        h = values[at:at + CHUNK] * a
        h += b
        np.minimum(low, h.min(1), out=low)
        np.maximum(high, h.max(1), out=high)
    return np.concatenate([low, high])


def band_keys(values: np.ndarray, band: int = BAND) -> list[int]:
    """A signed 64-bit key per band; a band holds values of ``band`` different permutations."""
    rows = values.reshape(-1, band)
    return [xxhash.xxh3_64_intdigest(r.tobytes(), seed=i) - (1 << 63) for i, r in enumerate(rows)]


def _sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """``uid, grams``: the sorted shingle set of each row of ``wanted`` (uid, doc_id, text_hash)."""
    @F.pandas_udf("binary")
    def grams(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shingles(words_of(t)).tobytes())

    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash"),
                        F.col(text_col).alias("text"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    return (texts.join(wanted.select("uid", "doc_id", "text_hash"), same)
            .groupBy("uid").agg(F.first("text").alias("text")).select("uid", grams("text").alias("grams")))


def signatures(docs: DataFrame, id_col: str, text_col: str, permutations: int = PERMUTATIONS,
               band: int = BAND, seed: int = 1) -> DataFrame:
    """``uid, doc_id, text_hash, n_shingles, content, bands`` per input row, over its whole text.
    ``content`` is the SHA-256 of the set (null if empty)."""
    a, b = multipliers(permutations, seed)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, content, bands = [], [], []
            last: tuple[bytes, list[int]] = (b"", [])
            for text in batch.pop("text"):
                found = shingles(words_of(text))
                n.append(len(found))
                if not len(found):
                    content.append(None)
                    bands.append(None)
                    continue
                digest = hashlib.sha256(found.tobytes()).digest()
                if digest != last[0]:
                    last = digest, band_keys(min_max(found, a, b), band)
                content.append(digest)
                bands.append(last[1])
            batch["n_shingles"], batch["content"], batch["bands"] = n, content, bands
            yield batch

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.mapInPandas(
        sign, f"uid long, doc_id {id_type}, text_hash long, n_shingles long, content binary, bands array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` (pivot, member, a, b) whose full sets meet
    ``100 * intersection >= percent * union``.

    Pairs are dealt to blocks by their member; a block gets each set it needs once, however many
    members a pivot is compared with.
    """
    blocks = max(1, math.ceil(pairs.count() / BLOCK_PAIRS))
    dealt = pairs.withColumn("block", F.pmod(F.xxhash64("member"), F.lit(blocks)))
    needed = dealt.select(F.col("block").alias("at"), F.explode(F.array("pivot", "member")).alias("set")).distinct() \
        .join(sets, F.col("set") == F.col("uid")).select(F.col("at"), F.col("set"), "grams")

    def compare(asked: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        known = {u: np.frombuffer(g, np.uint64) for u, g in zip(found["set"], found["grams"])}
        hits = []
        for pivot, part in asked.groupby("pivot", sort=False):
            one = known[pivot]
            for a, b, member in zip(part["a"], part["b"], part["member"]):
                two = known[member]
                at = np.minimum(np.searchsorted(one, two), len(one) - 1)
                both = int((one[at] == two).sum())
                if 100 * both >= percent * (len(one) + len(two) - both):
                    hits.append((a, b))
        return pd.DataFrame(hits, columns=["a", "b"])

    return dealt.groupBy("block").cogroup(needed.groupBy("at")).applyInPandas(compare, "a long, b long")


def _prefix_pairs(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (pivot, member, a, b) of ``rows`` (uid, n, class) in different classes that can be similar.

    Prefix filter (Xiao et al., PPJoin): with shingles in one order, rarest first, two similar sets
    share a shingle among the first ``n - ceil(t n)`` + 1 of the larger and the first
    ``n - ceil(2 t n / (1 + t))`` + 1 of the smaller one. Sets that were edited in more places than a
    link allows begin with shingles of their own and meet nothing, so groups of copies that are
    not alike enough are ruled out without looking at their pairs. No similar pair is lost.
    """
    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                grams = [np.frombuffer(g, np.int64) for g in part["grams"]]
                sizes = [len(g) for g in grams]
                yield pd.DataFrame({"uid": np.repeat(part["uid"].to_numpy(), sizes), "n": np.repeat(sizes, sizes),
                                    "class": np.repeat(part["class"].to_numpy(), sizes), "token": np.concatenate(grams)})

    tokens = materialise(rows.select("uid", "class").join(sets, "uid").mapInPandas(
        explode, "uid long, n long, class long, token long"), "minhash_tokens")
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = Window.partitionBy("uid")
    # shingles that no other set has come first and cannot be shared: they only take places
    place = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("df", "token")) - 1
    ordered = tokens.join(common, "token").select("uid", "n", "class", "token", place.alias("place"))
    probe = ordered.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100))
    probe = materialise(probe.withColumn("short", F.col("place") <= F.col("n")
                                         - F.ceil(F.col("n") * (2 * percent) / (100 + percent))), "minhash_prefixes")
    shared = probe.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high"),
                                        F.max("short").alias("met")).filter("low < high AND met").select("token")
    probe = probe.join(shared, "token")
    index = probe.filter("short").select(F.col("uid").alias("small"), F.col("n").alias("small_n"),
                                         F.col("class").alias("small_class"), F.col("place").alias("small_place"), "token")
    # position filter: from a pair's first shared shingle on, what is left must reach the overlap
    left = F.least(F.col("n") - F.col("place"), F.col("small_n") - F.col("small_place"))
    found = probe.join(index, "token").filter(
        (F.col("class") != F.col("small_class")) & (F.col("small_n") * 100 >= F.col("n") * percent)
        & (left * (100 + percent) >= (F.col("n") + F.col("small_n")) * percent)
        & ((F.col("small_n") < F.col("n")) | ((F.col("small_n") == F.col("n")) & (F.col("small") < F.col("uid")))))
    return found.select(F.col("small").alias("pivot"), F.col("uid").alias("member"), F.least("small", "uid").alias("a"),
                        F.greatest("small", "uid").alias("b")).dropDuplicates(["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                    seed: int = 1) -> DataFrame:
    """Classes of near duplicates: ``uid, doc_id, text_hash, n_shingles, component_id, kept, first``
    per input row.

    Two rows are linked if ``100 * intersection >= percent * union`` of their sets of distinct
    5-word shingles (ASCII lower case; fewer words make one shingle; no words, no links);
    a class is what links connect, its id the smallest identifier in it.

    1. One pass hashes every whole text: shingle set, its digest and the bands of a min-max
       signature (both extremes of each permutation, so half the hash evaluations).
    2. Rows with equal sets collapse to one representative by a map-side combined aggregate, so a
       hot group of copies costs one row from there on.
    3. Representatives that share a band are candidates. A band's bucket is not expanded into
       pairs: its members are compared with one pivot, the member that shares bands with the most
       others (in a group of edited copies that is the original, like all of them where they are
       unlike one another), which joins most of them to one class. What still lies in different
       classes of one bucket goes through an exact prefix filter, and the pairs it leaves are
       compared. Nothing is capped, and no link between classes is lost.
    4. Only representatives in some bucket of two or more get their sets built for the comparison.

    Null or empty texts: 0 shingles, own class, kept. Null identifiers: a class is named by the
    smallest non-null one (null if it has none); ``kept`` are the rows with that identifier, repeated ones
    included, and ``first`` is exactly one of them. An empty table gives no rows.
    """
    rows = materialise(signatures(docs, id_col, text_col, seed=seed), "minhash_rows")
    reps = materialise(
        rows.filter(F.col("content").isNotNull()).groupBy("content")
        .agg(F.min(F.struct("uid", "doc_id", "text_hash", F.col("n_shingles").alias("n"))).alias("r"))
        .select("content", "r.*"), "minhash_reps")
    banded = rows.select("uid", "bands").join(reps.select("uid", "n"), "uid") \
        .select("uid", "n", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = materialise(banded.join(shared, "bucket"), "minhash_buckets")
    degrees = members.groupBy("uid").agg((-F.sum("members")).alias("order"))
    members = materialise(members.drop("members").join(degrees, "uid"), "minhash_members")
    sets = materialise(_sets(docs, id_col, text_col, reps.join(members.select("uid").distinct(), "uid")),
                       "minhash_sets")

    # one pivot per bucket: the member that shares bands with the most others
    pivots = members.groupBy("bucket").agg(F.min(F.struct("order", "uid", "n")).alias("p")) \
        .select("bucket", F.col("p.uid").alias("pivot"), F.col("p.n").alias("pivot_n"))
    stars = (members.join(pivots, "bucket").filter("uid != pivot")
             .filter(F.least("n", "pivot_n") * 100 >= F.greatest("n", "pivot_n") * percent)
             .select("pivot", F.col("uid").alias("member"), F.least("uid", "pivot").alias("a"),
                     F.greatest("uid", "pivot").alias("b")).dropDuplicates(["a", "b"]))
    stars = materialise(stars, "minhash_pairs")
    links = materialise(_confirmed(stars, sets, percent), "minhash_links")
    classes = materialise(connected_components(links, "a", "b"), "minhash_classes")

    # what still lies in different classes of one bucket
    named = members.join(classes.select(F.col("node").alias("uid"), F.col("component").alias("class")), "uid", "left") \
        .withColumn("class", F.coalesce("class", "uid"))
    mixed = named.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")) \
        .filter("low < high").select("bucket")
    unsettled = materialise(named.join(mixed, "bucket").select("uid", "n", "class").distinct(), "minhash_open")
    rest = _prefix_pairs(unsettled, sets, percent).join(stars.select("a", "b"), ["a", "b"], "left_anti")
    rest = materialise(rest, "minhash_pairs")
    more = materialise(_confirmed(rest, sets, percent), "minhash_links")
    classes = materialise(connected_components(links.unionByName(more), "a", "b"), "minhash_classes")

    class_of = reps.join(classes, F.col("uid") == F.col("node"), "left") \
        .select("content", F.coalesce("component", "uid").alias("class"))
    member = rows.select("uid", "doc_id", "text_hash", "n_shingles", "content").join(class_of, "content", "left") \
        .withColumn("class", F.coalesce("class", -1 - F.col("uid")))
    first = member.groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("f")) \
        .select("class", F.col("f.doc_id").alias("component_id"), F.col("f.uid").alias("first_uid"))
    return member.join(first, "class").select(
        "uid", "doc_id", "text_hash", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("uid") == F.col("first_uid")).alias("first"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75
                         ) -> DataFrame:
    """The ``first`` row of each group of ``near_duplicates``, all columns unchanged. Rows equal in
    identifier and text are one document here and stay or go together."""
    marked = near_duplicates(docs, id_col, text_col, percent)
    gone = marked.groupBy(F.col("doc_id").alias("__gone_id"), F.col("text_hash").alias("__gone_hash")) \
        .agg(F.max("first").alias("__first")).filter("NOT __first")
    same = docs[id_col].eqNullSafe(F.col("__gone_id")) & (F.xxhash64(docs[text_col]) == F.col("__gone_hash"))
    return docs.join(gone, same, "left_anti")
