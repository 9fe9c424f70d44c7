"""Scaling of the fuzzy self-join on names of two words and a legal form, drawn from the words of documents.

usage: python tools/fuzzy_scale.py [sf_dir] [n1 n2 ...]

For each n: n distinct names in hash order, with a near copy of every fifth; prints n, the pairs of all
names, candidates of the segment signatures and of the bigram prefixes (up to 25,000 names), matches
and seconds. At n <= 2500 the matches are also checked against a brute-force LCS over all pairs.
"""

from __future__ import annotations

import itertools
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from custseg.functions.similarity import lcs_length  # noqa: E402
from custseg.operators import resolve as R  # noqa: E402
from custseg.operators import segments as S  # noqa: E402
from custseg.session import get_spark, materialise  # noqa: E402


def names(spark, sf_dir: str, n: int):
    """n names: two words of the documents and a legal form by hash, every fifth with one letter dropped."""
    words = (spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.explode(F.split("text", "[^A-Za-z]+")).alias("w"))
             .where(F.length("w") > 3).select(F.lower("w").alias("w")).distinct())
    words = words.withColumn("h", F.xxhash64("w")).orderBy("h").limit(20_000).select("w").collect()
    pool = F.array(*[F.lit(r.w) for r in words])
    forms = F.array(*[F.lit(v) for v in ("gmbh", "kg", "und sohn", "e.k.", "ag")])
    pick = lambda salt, array: F.get(array, F.pmod(F.xxhash64(F.lit(salt), "i"), F.size(array)).cast("int"))
    base = spark.range(n).withColumnRenamed("id", "i").withColumn("i", F.when(F.col("i") % 5 == 4, F.col("i") - 1).otherwise(F.col("i"))) \
        .withColumn("copy", F.monotonically_increasing_id())
    name = F.concat_ws(" ", pick("a", pool), pick("b", pool), pick("c", forms))
    at = F.pmod(F.xxhash64("copy"), F.lit(8)).cast("int") + 2
    rows = base.select(F.when(F.col("copy") % 5 == 4, F.concat(F.substring(name, F.lit(1), at - 1), F.substring(name, at + 1, F.lit(99))))
                       .otherwise(name).alias("key"))
    return materialise(rows.distinct(), "names")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    sizes = [int(x) for x in sys.argv[2:]] or [2_500, 25_000, 100_000]
    spark = get_spark("local[8]", shuffle_partitions=16, conf={"spark.driver.memory": "8g"})
    for n in sizes:
        sub = names(spark, sf_dir, n)
        m = sub.count()
        keys = R.distinct_keys(sub, "key")
        out = {"keys": m, "all_pairs": m * (m - 1) // 2}
        t0 = time.time()
        out["segments_per_key"] = round(S.segment_candidates(keys, 90).count() / m, 2)
        out["segment_seconds"] = round(time.time() - t0, 1)
        t0 = time.time()
        found = R.similar_key_pairs(sub, "key", keys=keys, method="segments")
        pairs = materialise(found.select("key_a", "key_b"), "pairs")
        out["matches"], out["join_seconds"] = pairs.count(), round(time.time() - t0, 1)
        if m <= 25_000:
            t0 = time.time()
            out["prefix_per_key"] = round(R.candidate_pairs(keys).count() / m, 2)
            out["prefix_seconds"] = round(time.time() - t0, 1)
        if m <= 2_500:
            ks = sorted(r.key for r in sub.collect())
            brute = {(a, b) for a, b in itertools.combinations(ks, 2)
                     if 90 * max(len(a), len(b)) <= 110 * min(len(a), len(b))   # necessary
                     and 200 * lcs_length(a, b) >= 90 * (len(a) + len(b))}
            out["equals_brute_force"] = brute == {(p.key_a, p.key_b) for p in pairs.collect()}
        print(json.dumps(out), flush=True)


if __name__ == "__main__":
    main()
