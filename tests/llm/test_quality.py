import pytest

from custseg.llm import quality
from tests.llm.helpers import documents

BASE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def weights(spark):
    return quality.fit(spark.read.parquet(f"{BASE}/documents.parquet"), spark.read.parquet(f"{BASE}/labels.parquet"))


def test_held_out_accuracy(spark, weights):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    got = quality.grade(docs, weights).toPandas().merge(spark.read.parquet(f"{BASE}/labels.parquet").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    good, junk = held[held["quality"] == 1], held[held["quality"] == 0]
    assert good["kept"].mean() > 0.99 and junk["kept"].mean() < 0.05


def test_sparse_sites_shrink_to_their_parents(spark, weights):
    fine = "This is a calm and ordinary line of text about the town. It has several words, all of them in use."
    junk = "### $$$ %%% &&& ### $$$ %%% &&& ### $$$ %%% &&&"
    rows = [(i, f"{fine} Number {i} of them was there.", "good") for i in range(60)]
    rows += [(100 + i, junk, "bad") for i in range(60)]
    rows += [(200, fine, "sparse"), (201, None, None), (202, "", "bad"), (None, fine, "bad"), (3, rows[3][1], "good")]
    got = quality.grade(documents(spark, rows, clash=True), weights).collect()
    assert len(got) == len(rows)
    host = {r.doc_id: r.host_score for r in got}
    assert host[5] > 0.9 and host[105] < 0.1 and host[105] < host[200] < host[5]
    score = {r.doc_id: (r.text_score, r.score) for r in got}
    assert score[None][1] < score[None][0]  # a fine text at a bad site
    assert score[5][1] >= score[5][0] - 1e-9


def test_no_labels_and_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights = quality.fit(documents(spark, [(1, "x", "a")]), labels)
    assert quality.grade(documents(spark, []), weights).count() == 0
    assert quality.grade(documents(spark, [(1, "one", "a")]), weights).count() == 1
