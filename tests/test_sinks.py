import glob
import os

from custseg.sources import tables


def test_csv_and_parquet_sinks(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "Müller/GmbH", 2.5), (2, None, None)], "id long, name string, total double")
    csv_dir = os.path.join(tmpdir_path, "csv")
    tables.write_csv(df.coalesce(1), csv_dir)
    text = open(glob.glob(os.path.join(csv_dir, "part-*.csv"))[0], encoding="utf-8").read().splitlines()
    assert text[0] == "id;name;total" and "1;Müller/GmbH;2.5" in text
    pq_dir = os.path.join(tmpdir_path, "pq")
    tables.write_parquet(df, pq_dir)
    assert sorted(tables.read_parquet(spark, pq_dir).collect()) == sorted(df.collect())
