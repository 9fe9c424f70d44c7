"""The fitted pipeline as one saved object, on tables and streams."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from custseg.operators.prepare import scale_data
from custseg.operators.score import score
from custseg.plans.ml_stages import FeatureScaler, NeighbourSegmenter
from custseg.sources.model_store import KnnModel

RAW, SCALED = ["recency", "frequency", "monetary"], ["recency_z", "frequency_z", "monetary_z"]


def labelled(spark, n=300):
    rng = np.random.default_rng(4)
    rows = [(i, *map(float, rng.normal(size=3) * [100, 3, 900] + 500), int(rng.integers(0, 4))) for i in range(n)]
    return spark.createDataFrame(rows, "id long, recency double, frequency double, monetary double, cluster int")


def test_saved_pipeline_scores_tables_and_streams_alike(spark, tmpdir_path):
    train = labelled(spark)
    fitted = Pipeline(stages=[FeatureScaler(inputCols=RAW, outputCols=SCALED), NeighbourSegmenter(inputCols=SCALED, k=7)]).fit(train)
    fitted.write().overwrite().save(tmpdir_path + "/model")
    loaded = PipelineModel.load(tmpdir_path + "/model")
    odd = spark.createDataFrame([(None, None, 1.0, 2.0, None), (5, 400.0, 501.0, 100.0, None)], train.schema)
    rows = train.unionByName(odd).drop("cluster")
    got = {(r.id, r.recency): r.segment for r in loaded.transform(rows).collect()}
    scaled, scaler = scale_data(train, RAW)
    model = KnnModel(scaler, scaled.select("id", *RAW, "cluster"), RAW, 7)
    assert got == {(r.id, r.recency): r.segment for r in score(rows, model).collect()}
    assert got[None, None] is None and got[5, 400.0] is not None

    rows.write.parquet(tmpdir_path + "/in")
    stream = loaded.transform(spark.readStream.schema(rows.schema).parquet(tmpdir_path + "/in"))
    query = (stream.writeStream.format("memory").queryName("staged").outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", tmpdir_path + "/checkpoint").start())
    query.awaitTermination(120)
    assert {(r.id, r.recency): r.segment for r in spark.table("staged").collect()} == got


def test_large_models_are_joined_with_the_same_result(spark):
    train = labelled(spark, 120)
    small, large = (NeighbourSegmenter(inputCols=RAW, k=3, maxPoints=n).fit(train) for n in (1_000, 10))
    pick = lambda m: sorted((r.id, r.segment) for r in m.transform(train).collect())
    assert pick(small) == pick(large)
    assert large.copy().points is large.points


def test_constant_column_and_no_rows(spark):
    train = labelled(spark, 20).withColumn("frequency", F.lit(2.0))
    model = FeatureScaler(inputCols=RAW, outputCols=SCALED).fit(train)
    assert {r.frequency_z for r in model.transform(train).collect()} == {0.0}
    empty = NeighbourSegmenter(inputCols=RAW).fit(train.limit(0))
    assert {r.segment for r in empty.transform(train).collect()} == {None}
    with pytest.raises(KeyError):
        NeighbourSegmenter(k=3).fit(train)
