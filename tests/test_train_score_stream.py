"""Training plan smoke test, model round trip, batch and streaming scoring."""

import os
import tempfile

from pyspark.sql import functions as F

from custseg import constants as C
from custseg.operators.score import score
from custseg.plans import catalog, training
from custseg.sources.model_store import load_model
from custseg.streaming import score_stream


SMOKE_SCORING_ROWS = [(10, 15, 5500), (160, 2, 450), (749, 4, 7000)]


def test_train_save_score_stream(spark):
    rfm = catalog.rfm_orders(spark, "/root/testdata/sf0.01")
    res = training.train(rfm, sweep=[1, 2, 3])
    assert set(r.cluster for r in res.labelled.select("cluster").distinct().collect()) == {0, 1, 2, 3}
    assert 1 <= res.metrics["knn_best_k"] <= 47 and res.metrics["silhouette_sq"] is not None
    assert res.report.where(F.col("class") == "accuracy").first().precision > 0.5
    assert res.centres.count() == 4 * 3
    metrics = training.run_metrics(res, "run-1")
    assert metrics.where("kind = 'curve' AND name = 'sse'").count() == 3

    assert metrics.where("kind = 'param' AND name = 'n_clusters' AND text = '4'").count() == 1
    assert metrics.where("kind = 'box' AND name = 'initial:monetary:median'").count() == 1
    assert metrics.where("kind = 'confusion'").agg({"value": "sum"}).first()[0] == metrics.where(
        "kind = 'report' AND name = 'accuracy:support'").first().value
    assert res.metrics["rows_initial"] - res.metrics["rows_kept"] == res.metrics["outliers_removed"]
    sinks = tempfile.mkdtemp(prefix="custseg-run-")
    assert abs(res.metrics["silhouette"]) <= 1 and 0 <= res.metrics["silhouette_error"] <= C.SILHOUETTE_TOLERANCE
    assert [r.silhouette is None for r in res.sse.orderBy("k").collect()] == [True, False, False]
    training.write_run(res, sinks, "a")
    assert sorted(spark.read.parquet(f"{sinks}/runs").columns) == sorted(metrics.columns)
    assert spark.read.parquet(f"{sinks}/labelled").count() == res.metrics["rows_kept"]

    path = f"{sinks}/model"
    model = load_model(spark, path)
    assert model.k == res.model.k and model.features == C.RFM_FEATURES

    rows = [(i, float(r), float(f), float(m)) for i, (r, f, m) in enumerate(SMOKE_SCORING_ROWS)]
    raw = spark.createDataFrame(rows, "id long, recency double, frequency double, monetary double")
    batch = {r.id: r.segment for r in score(raw, model).collect()}
    assert set(batch) == {0, 1, 2} and all(v in {0, 1, 2, 3} for v in batch.values())

    src = tempfile.mkdtemp(prefix="custseg-stream-")
    raw.write.mode("overwrite").parquet(os.path.join(src, "batch1"))
    stream = spark.readStream.schema(raw.schema).parquet(os.path.join(src, "batch1"))
    q = (score_stream(stream, model).writeStream.format("memory").queryName("scored")
         .outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="custseg-sckpt-")).start())
    q.awaitTermination(120)
    streamed = spark.sql("SELECT * FROM scored")
    assert streamed.columns == score(raw, model).columns
    assert sorted(streamed.collect()) == sorted(score(raw, model).collect())   # all columns, unscaled

    odd = spark.createDataFrame([(7, 10.0, 15.0, 5500.0), (7, 749.0, 4.0, 7000.0), (None, 10.0, 15.0, 5500.0),
                                 (None, None, 1.0, 1.0)], raw.schema)
    got = [(r.id, r.recency, r.segment) for r in score(odd, model).collect()]
    assert got == [(7, 10.0, batch[0]), (7, 749.0, batch[2]), (None, 10.0, batch[0]), (None, None, None)]


def test_a_run_that_is_written_again_replaces_its_rows(spark, tmpdir_path):
    rows = lambda run, n: spark.createDataFrame(
        [(run, "metric", f"m{i}", None, float(i), None) for i in range(n)], training.RUN_SCHEMA)
    for run, n in (("a", 3), ("b", 4), ("a", 3), ("a", 2)):
        training.write_run_rows(rows(run, n), tmpdir_path + "/runs")
    back = spark.read.parquet(tmpdir_path + "/runs")
    assert {r.run_id: r["count"] for r in back.groupBy("run_id").count().collect()} == {"a": 2, "b": 4}
