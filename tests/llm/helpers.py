"""Small document tables for the llm tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside; a table may hold any of them as well
CLASHES = ["uid", "row", "norm", "hash", "salt", "rank", "size", "target", "taken", "shard", "ids", "n", "bands", "class",
           "id", "gram", "start", "key", "half", "score", "_id", "_hash", "name", "kept"]


def sentence(rng, words=12):
    return " ".join(rng.choice(STOCK) for _ in range(words))


_r = random.Random(7)
STOCK = ["".join(_r.choice("abcdeiorstn") for _ in range(_r.randint(1, 8))) for _ in range(400)]


def documents(spark, rows, clash=False):
    """A documents table from (doc_id, text, source) tuples."""
    df = spark.createDataFrame([(i, t, "en", s, len(t) if t else None) for i, t, s in rows], SCHEMA)
    if clash:
        from pyspark.sql import functions as F
        for k, name in enumerate(CLASHES):
            df = df.withColumn(name, F.lit(k))
    return df
