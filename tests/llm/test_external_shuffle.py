import zlib

import numpy as np
from pyspark.sql import functions as F

from custseg.llm import external_shuffle
from tests.conftest import SF001
from tests.llm.helpers import documents


def plain_fisher_yates(rows, seed, bucket):
    """The draw of a bucket by the algorithm itself, on a plain list with the same generator."""
    rng = np.random.Generator(np.random.PCG64([seed, bucket]))
    at = np.arange(len(rows))
    rng.shuffle(at)
    return [rows[i] for i in at]


def check(docs, shards=24, **options):
    rows = external_shuffle.shuffled(docs, shards=shards, **options)
    out = [r.asDict() for r in external_shuffle.digest(rows).collect()]
    n = docs.count()
    assert len(out) == n
    want = sorted((str(r.doc_id), len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == want
    per = {}
    for r in out:
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        per.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    counts = [len(per.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    return rows, out


def test_counts_slots_and_content_on_test_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows, out = check(docs, bucket_bytes=20_000)
    assert len({r["bucket"] for r in out}) > 10
    # pass 2 is Fisher and Yates's shuffle of each bucket's rows in order of their numbers
    total = docs.agg(F.sum(F.octet_length("text") + 8)).first()[0]
    first = external_shuffle.scattered(docs, -(-total // 20_000)).select("row.doc_id", "uid", "bucket").collect()
    placed = {(r["bucket"], r["place"]): r["doc_id"] for r in out}
    for b in {r.bucket for r in first}:
        ids = [r.doc_id for r in sorted((r for r in first if r.bucket == b), key=lambda r: r.uid)]
        assert [placed[b, k] for k in range(len(ids))] == plain_fisher_yates(ids, external_shuffle.SEED, b)


def test_reruns_agree_and_seeds_differ(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    place = lambda **o: {r.doc_id: (r.shard, r.slot) for r in external_shuffle.digest(
        external_shuffle.shuffled(docs, bucket_bytes=50_000, **o)).collect()}
    one = place()
    assert one == place() and one != place(seed=5)


def test_order_is_uniform(spark):
    docs = documents(spark, [(i, f"text {i}", "a") for i in range(2_400)])
    _, out = check(docs, bucket_bytes=1_500)
    # chi square of (tenth of the input) x (shard), 9 x 23 degrees of freedom: mean 207, deviation 20
    table = np.zeros((10, 24))
    for r in out:
        table[r["doc_id"] // 240, r["shard"]] += 1
    assert ((table - 10) ** 2 / 10).sum() < 207 + 5 * 20
    by_place = [r["doc_id"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    rising = sum(a < b for a, b in zip(by_place, by_place[1:]))
    assert abs(rising - 1_200) < 5 * (2_400 / 12) ** 0.5


def test_repeated_rows_spread(spark):
    rows = [(None, "a licence line", None)] * 400 + [(i, f"t {i}", "a") for i in range(400)]
    rows += [(5, None, "x"), (6, "", "x"), (7, "long " * 60_000, "x"), (7, "long " * 60_000, "x")]
    docs = documents(spark, rows, clash=True)
    _, out = check(docs, bucket_bytes=1_000)
    lines = [r["bucket"] for r in out if r["doc_id"] is None]
    assert max(lines.count(b) for b in set(lines)) < 20


def test_fewer_rows_than_shards_and_empty_table(spark):
    check(documents(spark, [(i, "x", "a") for i in range(5)]))
    rows, out = check(documents(spark, []))
    assert out == [] and set(rows.columns) == {"bucket", "row", "place", "position", "shard", "slot"}


def test_written_shards(spark, tmpdir_path):
    docs = documents(spark, [(i, f"text {i}", "a") for i in range(100)], clash=True)
    rows = external_shuffle.shuffled(docs, shards=4, bucket_bytes=300)
    external_shuffle.write_shards(rows, tmpdir_path + "/out")
    back = spark.read.parquet(tmpdir_path + "/out")
    assert back.select("row.*").columns == docs.columns
    assert sorted((r.shard, r.slot, r.row.doc_id) for r in back.collect()) == \
        sorted((r.shard, r.slot, r.row.doc_id) for r in rows.collect())
