import datetime as dt

from pyspark.sql import Row

from custseg.operators import rfm

D = dt.date


def _rows(spark, rows):
    return spark.createDataFrame(
        [Row(invoice_num=a, customer_id=b, date=c, total=d, is_total=e, item_id=f) for a, b, c, d, e, f in rows],
        "invoice_num string, customer_id string, date date, total double, is_total boolean, item_id string")


def test_rfm_cases(spark):
    rows = [
        # two invoices of one customer on one day -> one visit
        ("1", "a", D(2020, 1, 1), 10.0, True, None),
        ("2", "a", D(2020, 1, 1), 5.0, True, None),
        ("3", "a", D(2020, 1, 5), 1.0, True, None),
        # one-time customer holding the newest date: still the recency anchor
        ("4", "b", D(2020, 1, 10), 7.0, True, None),
        # excluded item on invoice 5 removes its total row as well
        ("5", "c", D(2020, 1, 2), 100.0, True, None),
        ("5", "c", D(2020, 1, 2), None, False, "11109"),
        ("6", "c", D(2020, 1, 3), 2.0, True, None),
        ("7", "c", D(2020, 1, 4), 3.0, True, None),
        # null customer, null date, non-total rows, outside window
        ("8", None, D(2020, 1, 3), 9.0, True, None),
        ("9", "d", None, 9.0, True, None),
        ("10", "d", D(2020, 1, 3), 9.0, None, None),
        ("11", "d", D(2019, 1, 1), 9.0, True, None),
        ("12", "d", D(2020, 1, 6), 9.0, True, None),
        ("13", "d", D(2020, 1, 7), None, True, None),
    ]
    df = _rows(spark, rows)
    out = rfm.rfm_from_invoices(df, date_from="2020-01-01", date_to="2020-01-10")
    got = {r.customer_id: (r.recency, r.frequency, r.monetary) for r in out.collect()}
    assert got == {"a": (5, 2, 16.0), "c": (6, 2, 5.0), "d": (3, 2, 9.0)}


def test_null_invoice_matches_null(spark):
    rows = [
        (None, "a", D(2020, 1, 1), 1.0, True, None),
        (None, "a", D(2020, 1, 2), None, False, "33333"),
        ("x", "a", D(2020, 1, 3), 1.0, True, None),
    ]
    kept = rfm.exclude_invoices(_rows(spark, rows))
    assert [r.invoice_num for r in kept.collect()] == ["x"]


def test_default_window_clamps_leap_day():
    start, end = rfm.default_window(D(2024, 2, 29))
    assert start == D(2019, 2, 28) and end == D(2024, 2, 29)


def test_flagship_plan_pushes_columns(spark):
    from custseg.plans import catalog
    df = catalog.queries()["rfm_features"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # only the needed orders columns are read
    assert "o_orderpriority" not in plan and "o_orderstatus" not in plan
    assert df.count() > 0


def test_totals_below_a_cent_are_kept(spark):
    rows = [(1, "c", f"2020-01-0{d}", 0.125, True) for d in (1, 2, 3)] + [(2, "d", "2020-01-01", 0.0625, True)]
    df = spark.createDataFrame(rows, "invoice_num long, customer_id string, date string, total double, is_total boolean")
    base = rfm.rfm_base(df, date_from="2020-01-01", date_to="2020-12-31")
    assert {r.customer_id: r.monetary for r in rfm.monetary(base).collect()} == {"c": 0.375, "d": 0.0625}
    assert rfm.rfm_features(base).first().monetary == 0.375
