"""Golden mini-fixture: two raw exports in ISO-8859-15 through the cleaning plan."""

import hashlib
import os

import pytest

from custseg import constants as C
from custseg.plans.cleaning import clean_exports
from custseg.sources import raw_text


def _row(**kw):
    vals = {c: "" for c in C.RAW_COLUMNS}
    vals.update({"date": "1.2.2020", "invoice_num": "R1", "name": "100 - Müller · GmbH",
                 "license_plate": "abc", "mileage": "1000", "vin": "", "manufacturer": "VW",
                 "type": "Golf", "first_registration": "01.2010", "address_company": "Müller GmbH",
                 "address_name": "Herr Hans Müller", "address_street_house_number": "Hauptstr. 5",
                 "address_postal_code_city": "12345 Ort", "address_other": "x",
                 "item_id": "", "item_description": "Preis 5€; Prüfung", "is_total": "",
                 "amount": "2", "price": "1.234,56", "total": "-5", "balance": "0"})
    vals.update(kw)
    return "\t".join(vals[c] for c in C.RAW_COLUMNS)


@pytest.fixture(scope="module")
def export_dir():
    import tempfile
    d = tempfile.mkdtemp(prefix="custseg-raw-")
    header = "\t".join(f"Spalte {i}" for i in range(21))
    a = [header,
         _row(item_id="11109"),
         _row(is_total="-SPLITTEN-", amount="-2", total="-5", item_id=""),
         "\t".join(["1"] * 20),                                           # ragged: 20 fields
         _row(invoice_num="R2", name="101 - Mueller", address_name="Hans Müller", total="7,5",
              is_total="-SPLITTEN-"),
         _row(invoice_num="R3", name="10 - Barverkauf", is_total="-SPLITTEN-"),  # walk-in
         _row(invoice_num="R4", name="Solo", address_company="Solo AG", address_name="",
              is_total="-SPLITTEN-", license_plate="")]
    b = [header,
         _row(date="31.02.2020", invoice_num="R5", name="102 - M", address_name="Hans Mülller",
              is_total="-SPLITTEN-", total="1.000,00")]
    with open(os.path.join(d, "A_2020.TXT"), "w", encoding="iso8859_15") as f:
        f.write("\n".join(a) + "\n")
    with open(os.path.join(d, "B_2021.TXT"), "w", encoding="iso8859_15") as f:
        f.write("\n".join(b) + "\n")
    with open(os.path.join(d, "ignored.csv"), "w") as f:
        f.write(header + "\n" + _row() + "\n")
    with open(os.path.join(d, "ignored.txt"), "w") as f:
        f.write(header + "\n" + _row() + "\n")
    os.makedirs(os.path.join(d, "sub"))
    with open(os.path.join(d, "sub", "nested.TXT"), "w") as f:
        f.write(header + "\n" + _row() + "\n")
    return d


def test_empty_input_raises(spark, tmpdir_path):
    with pytest.raises(raw_text.EmptyInputError):
        raw_text.read_raw_export(spark, tmpdir_path)


def test_raw_lines_charset_and_headers(spark, export_dir):
    ex = raw_text.read_raw_export(spark, export_dir)
    rows = ex.rows.collect()
    assert len(rows) == 6                         # 7 data lines, one ragged
    assert ex.quarantine.count() == 1
    assert {r.file for r in rows} == {"A_2020.TXT", "B_2021.TXT"}
    first = min(rows, key=lambda r: r.ordinal)
    assert first.fields[2] == "100 - Müller - GmbH"          # middle dot -> hyphen
    assert first.fields[15] == "Preis 5€/ Prüfung"           # latin-9 euro, ';' -> '/'


def test_clean_plan(spark, export_dir):
    res = clean_exports(spark, export_dir)
    inv = {r.invoice_num + ("T" if r.is_total else "I"): r for r in res.invoices.collect()}
    assert set(res.invoices.columns) == {
        "date", "invoice_num", "license_plate", "mileage", "vin", "manufacturer", "type",
        "first_registration", "item_id", "item_description", "is_total", "amount", "price",
        "total", "customer_number", "customer_id"}
    assert "R3T" not in inv                                   # walk-in dropped
    r1 = inv["R1I"]
    assert r1.is_total is None and r1.amount == -2.0 and r1.total == 5.0 and r1.price == 1234.56
    assert r1.license_plate == "a9993e364706816a" and r1.vin is None
    assert str(r1.date) == "2020-02-01"
    assert inv["R1T"].amount == 2.0 and inv["R1T"].is_total is True
    assert inv["R5T"].date is None and inv["R5T"].total == 1000.0
    assert inv["R4T"].customer_number == "Solo" and inv["R4T"].license_plate is None
    # 100, 101 (same key after salutation removal) and 102 (one typo) are one customer,
    # named after the earliest entry's key
    key = "müller gmbh hans müller"
    expect = hashlib.sha256(key.encode()).hexdigest()
    assert inv["R1T"].customer_id == inv["R2T"].customer_id == inv["R5T"].customer_id == expect
    assert inv["R4T"].customer_id == hashlib.sha256("solo ag".encode()).hexdigest()


def test_walk_in_keep(spark, export_dir):
    res = clean_exports(spark, export_dir, walk_in="keep")
    ids = {r.invoice_num: r.customer_id for r in res.invoices.where("is_total").collect()}
    assert ids["R3"] == "10"


def test_clean_plan_ordered_grouping(spark, export_dir):
    res = clean_exports(spark, export_dir, grouping="ordered")
    ids = {r.invoice_num: r.customer_id for r in res.invoices.where("is_total").collect()}
    # 100 and 101 share a key; 102 is similar to both: one order-dependent group
    assert ids["R1"] == ids["R2"] == ids["R5"]


def test_file_names_decoded_and_ordered(spark, tmpdir_path):
    header = "\t".join(f"c{i}" for i in range(21))
    for name, val in [("b x+y.TXT", "2"), ("a ü.TXT", "1")]:
        with open(os.path.join(tmpdir_path, name), "w", encoding="iso8859_15") as f:
            f.write(header + "\n" + "\t".join([val] * 21) + "\n")
    rows = raw_text.read_raw_export(spark, tmpdir_path).rows.orderBy("ordinal").collect()
    assert [r.file for r in rows] == ["a ü.TXT", "b x+y.TXT"]
    assert [r.fields[0] for r in rows] == ["1", "2"]


def test_line_order_across_file_splits(spark, tmpdir_path):
    """A file read in many partitions keeps its line order; only line 1 is a header."""
    header = "\t".join(f"c{i}" for i in range(21))
    lines = [header] + ["\t".join([str(i)] * 21) for i in range(3000)]
    with open(os.path.join(tmpdir_path, "big.TXT"), "w", encoding="iso8859_15") as f:
        f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        ex = raw_text.read_raw_export(spark, tmpdir_path)
        assert ex.rows.rdd.getNumPartitions() > 1
        got = [int(r.fields[0]) for r in ex.rows.orderBy("ordinal").collect()]
        assert got == list(range(3000))
        ex.quarantine.write.format("noop").mode("overwrite").save()
        assert raw_text.ingest_counts(ex) == {"columns": 21, "rows": 3001, "kept": 3000, "removed": 0}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_invoice_lines_are_rendered_once(spark, tmp_path):
    """No filter on the fields may go below the exchange, where it would render and split every line again, and
    nothing is written between rendering and typing."""
    import datetime

    from custseg.plans import catalog

    spark.createDataFrame([(1, "A", "X"), (10, "B", "Y")], "c_custkey long, c_name string, c_mktsegment string") \
        .write.parquet(f"{tmp_path}/customer.parquet")
    day = datetime.datetime(1996, 2, 3)
    spark.createDataFrame([(7, 1, day, 1234.5), (8, 10, day, 5.0)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(7, 3, 1, 2.0, 10.25)],
                          "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    out = catalog.queries()["clean_invoices"](spark, str(tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat_ws") == 1 and "invoice_fields" not in plan
    rows = {(r.invoice_num, r.item_id, r.is_total, r.amount, r.total, r.customer_number) for r in out.collect()}
    assert rows == {("7", "3", None, -2.0, None, "1"), ("7", None, True, None, 1234.5, "1")}
