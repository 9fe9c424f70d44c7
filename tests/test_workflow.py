"""Raw .TXT files through cleaning, features, training and scoring."""

import tempfile

from custseg import constants as C
from custseg.operators.score import score
from custseg.plans.workflow import run_all
from custseg.sources import tables
from custseg.sources.model_store import load_model


def test_raw_text_to_scored_rows(spark):
    lines = [r.line for r in tables.invoice_lines(spark, "/root/testdata/sf0.001").orderBy("ordinal").collect()]
    raw, out = tempfile.mkdtemp(prefix="custseg-raw-"), tempfile.mkdtemp(prefix="custseg-out-")
    half = len(lines) // 2
    for name, part in (("a.TXT", lines[:half]), ("b.TXT", lines[half:] + ["too\tfew\tfields"]), ("c.csv", ["x"])):
        with open(f"{raw}/{name}", "w", encoding="iso8859_15") as f:
            f.write("\n".join(["\t".join(C.RAW_COLUMNS), *part]))
    result = run_all(spark, raw, out, "run-1", "1990-01-01", "2010-01-01", ["7"],
                     clean_options={"cutoff": 99}, train_options={"sweep": [1, 2, 3]})
    assert spark.read.parquet(f"{out}/quarantine").count() == 1
    invoices = spark.read.parquet(f"{out}/invoices")
    assert invoices.filter("customer_number != '10'").count() == invoices.count() > 0.9 * len(lines)
    features = spark.read.parquet(f"{out}/features")
    assert features.count() > 20 and features.columns == ["customer_id", *C.RFM_FEATURES]
    runs = spark.read.parquet(f"{out}/runs")
    assert {r.kind for r in runs.select("kind").distinct().collect()} == \
        {"param", "metric", "curve", "confusion", "report", "box"}
    assert spark.read.parquet(f"{out}/labelled").count() == result.metrics["rows_kept"]
    scored = score(features, load_model(spark, f"{out}/model"))
    assert scored.columns == [*features.columns, "segment"]
    assert {r.segment for r in scored.select("segment").distinct().collect()} <= {0, 1, 2, 3}


def test_csv_scan_with_and_without_quotes(spark):
    path = tempfile.mkdtemp(prefix="custseg-csv-")
    with open(f"{path}/a.csv", "w", encoding="utf-8") as f:
        f.write('a;b\n"x;y";1\nz;2\n')
    assert [tuple(r) for r in tables.read_csv(spark, path, quotes=True).collect()] == [("x;y", "1"), ("z", "2")]
    assert tables.read_csv(spark, path).first().a == '"x'
    assert tables.read_csv(spark, path, columns=["p", "q"], quotes=True).columns == ["p", "q"]
