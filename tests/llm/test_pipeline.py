"""Every stage of the pipeline against a brute-force version on the smallest tables."""

import random
import re

import numpy as np

import corpus_pipeline
from custseg.llm import catalog
from custseg.session import materialise
from tests.llm.helpers import documents, sentence
from tests.llm.test_minhash import brute as near
from tests.llm.test_mixing import targets

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    from tokenizers import Tokenizer
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id: r for r in docs.collect()}
    for (name, stage) in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF), "test")
        rows = out.collect()
        if name != "packing":
            assert out.columns == columns
        if name == "toxicity":
            toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
            left = {r.doc_id for r in rows}
            lost = set(kept) - left
            assert len(lost - toxic) <= 6 and len(lost & toxic) >= 5
            kept = {i: kept[i] for i in left}
        elif name == "exact dedup":
            first = {}
            for r in kept.values():
                t = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
                first[t] = min(first.get(t, r.doc_id), r.doc_id)
            assert sorted(r.doc_id for r in rows) == sorted(first.values())
            kept = {i: kept[i] for i in first.values()}
        elif name == "near dedup":
            want = {c if c is not None else i for i, _, c in near([(r.doc_id, r.text, r.source) for r in kept.values()])}
            assert {r.doc_id for r in rows} == want
            kept = {i: kept[i] for i in want}
        elif name == "mixing":
            size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for i, r in kept.items()}
            per, took, largest = {}, {}, {}
            for i, r in kept.items():
                per[r.source] = per.get(r.source, 0) + size[i]
                largest[r.source] = max(largest.get(r.source, 0), size[i])
            for r in rows:
                assert r == kept[r.doc_id]
                took[r.source] = took.get(r.source, 0) + size[r.doc_id]
            for s, t in targets(per).items():
                assert abs(took.get(s, 0) - t) <= largest[s] / 2 + 1
            mixed = [(r.doc_id, r.text) for r in rows]
        else:
            tokenizer = Tokenizer.from_file(catalog.tokenizer_path())
            ids = sorted(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in mixed)
            assert sum(r.length for r in rows) == sum(map(len, ids))
            whole = [tuple(np.frombuffer(r.ids, "<u2").tolist()) for r in rows if r.length == r.doc_tokens]
            assert set(whole) <= set(ids)
        docs = out


def test_run_leaves_other_queries_their_tables(spark):
    lazy = catalog.op3_exact_dedup(spark, SF)
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert lazy.count() == 200
    assert corpus_pipeline.oracle_sql() == {}


def test_odd_tables(spark, tmpdir_path):
    """Null identifiers, texts and sources, repeated rows, clashing names; then no documents at all."""
    rng = random.Random(2)
    rows = [(i, sentence(rng, 40), rng.choice(["a", "b", None])) for i in range(40)]
    rows += [(None, None, None), (None, sentence(rng, 30), "a"), (50, "", "b"), (51, " \t\n", "b"), (3, rows[3][1], "a"),
             (3, rows[3][1], "a"), (60, rows[5][1], None), (61, "long word " * 5_000, "a")]
    docs = documents(spark, rows, clash=True)
    spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int") \
        .write.parquet(tmpdir_path + "/labels.parquet")
    docs.write.parquet(tmpdir_path + "/documents.parquet")
    mixed = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        mixed = materialise(stage(spark, mixed, tmpdir_path), "test")
        assert mixed.columns == docs.columns
        ids = [r.doc_id for r in mixed.select("doc_id").collect()]
        if name in ("exact dedup", "near dedup"):
            assert ids.count(3) <= 1 and not {5, 60} <= set(ids)
    assert corpus_pipeline.run(spark, tmpdir_path).count() > 0
    empty = tmpdir_path + "/empty"
    docs.limit(0).write.parquet(empty + "/documents.parquet")
    spark.read.parquet(tmpdir_path + "/labels.parquet").write.parquet(empty + "/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
