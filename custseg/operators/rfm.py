"""Recency / frequency / monetary features from invoice rows.

Semantics (null handling stated once, applied everywhere):

- invoices that contain an excluded item are removed completely; a null invoice number
  matches a null invoice number (null-safe anti join);
- only total rows count, null ``is_total`` is not a total row;
- the date window is inclusive on both ends, a null date is outside;
- null customer or null date rows are dropped before grouping;
- same-day invoices of one customer are one visit whose total is the sum (0.0 if all
  totals are null);
- recency = days between the customer's last visit and the newest visit of *any*
  customer in the window (taken before one-time customers are removed);
- frequency = number of visit days; customers with a single visit day are removed;
- monetary = sum of visit totals.

Totals are summed as doubles, unrounded.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..session import materialise


def excluded_invoices(items: DataFrame, excluded_ids: Iterable, invoice_col: str = "invoice_num",
                      item_col: str = "item_id") -> DataFrame:
    """Distinct invoice numbers having at least one row whose item id is excluded."""
    ids = list(excluded_ids)
    return (items.where(F.col(item_col).isin(ids))
            .select(F.col(invoice_col).alias("_excluded_invoice")).distinct())


def exclude_invoices(rows: DataFrame, excluded_ids: Iterable = C.EXCLUDED_ITEM_IDS,
                     invoice_col: str = "invoice_num", item_col: str = "item_id",
                     items: DataFrame | None = None, items_invoice_col: str | None = None) -> DataFrame:
    """Drop every row of an invoice that has an excluded item.

    ``items`` defaults to ``rows`` (one table holding item and total rows). The set of bad
    invoices is an aggregate whose size is only known at run time, so the join strategy is
    left to AQE: it becomes a broadcast anti join when the set is small.
    """
    items = rows if items is None else items
    bad = excluded_invoices(items, excluded_ids, items_invoice_col or invoice_col, item_col)
    return rows.join(bad, rows[invoice_col].eqNullSafe(bad["_excluded_invoice"]), "left_anti")


def rfm_base(rows: DataFrame, customer_col: str = "customer_id", date_col: str = "date",
             total_col: str = "total", is_total_col: str | None = "is_total",
             date_from: _dt.date | str | None = None, date_to: _dt.date | str | None = None) -> DataFrame:
    """Visits: one row per (customer, day) with the day's total -> (customer_id, date, total)."""
    df = rows
    if is_total_col is not None:
        df = df.where(F.col(is_total_col))
    day = F.to_date(F.col(date_col))
    if date_from is None or date_to is None:
        d_from, d_to = default_window()
        date_from = date_from or d_from
        date_to = date_to or d_to
    df = df.where(day.between(F.lit(str(date_from)).cast("date"), F.lit(str(date_to)).cast("date")))
    df = df.where(F.col(customer_col).isNotNull())
    money = F.col(total_col).cast("double")
    return (df.groupBy(F.col(customer_col).alias("customer_id"), day.alias("date"))
            .agg(F.coalesce(F.sum(money), F.lit(0.0)).alias("total")))


def default_window(today: _dt.date | None = None) -> tuple[_dt.date, _dt.date]:
    """today - 5 years ... today; 29 February clamps to 28 February."""
    today = today or _dt.date.today()
    year = today.year - C.DEFAULT_LOOKBACK_YEARS
    try:
        start = today.replace(year=year)
    except ValueError:
        start = today.replace(year=year, day=28)
    return start, today


def recency(base: DataFrame) -> DataFrame:
    """(customer_id, recency): days from the customer's last visit to the newest visit."""
    last = materialise(base.groupBy("customer_id").agg(F.max("date").alias("last_visit")), "rfm_last")
    anchor = last.agg(F.max("last_visit")).scalar()
    return last.select("customer_id", F.datediff(anchor, F.col("last_visit")).alias("recency"))


def frequency(base: DataFrame) -> DataFrame:
    """(customer_id, frequency): visit days per customer, single-visit customers removed."""
    return (base.groupBy("customer_id").agg(F.count("date").alias("frequency"))
            .where(F.col("frequency") != 1))


def monetary(base: DataFrame) -> DataFrame:
    """(customer_id, monetary): sum of visit totals."""
    return base.groupBy("customer_id").agg(F.sum("total").alias("monetary"))


def rfm_features(base: DataFrame) -> DataFrame:
    """(customer_id, recency int, frequency bigint, monetary double), frequency > 1.

    One aggregate per customer replaces three aggregates and their joins. It is written once
    to the shared folder, so the anchor (a scalar subquery) and everything that fits something
    to the features read it back instead of scanning the invoices again.
    """
    per = base.groupBy("customer_id").agg(
        F.max("date").alias("last_visit"),
        F.count("date").alias("frequency"),
        F.sum("total").alias("monetary"))
    per = materialise(per, "rfm_customers")
    anchor = per.agg(F.max("last_visit")).scalar()
    return (per.where(F.col("frequency") != 1)
            .select("customer_id",
                    F.datediff(anchor, F.col("last_visit")).alias("recency"),
                    "frequency",
                    "monetary"))


def rfm_from_invoices(rows: DataFrame, date_from=None, date_to=None,
                      excluded_ids: Iterable = C.EXCLUDED_ITEM_IDS, **cols) -> DataFrame:
    """Cleaned invoice rows -> RFM features (exclusion, window, visits, features)."""
    kept = exclude_invoices(rows, excluded_ids,
                            invoice_col=cols.get("invoice_col", "invoice_num"),
                            item_col=cols.get("item_col", "item_id"))
    base = rfm_base(kept, customer_col=cols.get("customer_col", "customer_id"),
                    date_col=cols.get("date_col", "date"), total_col=cols.get("total_col", "total"),
                    is_total_col=cols.get("is_total_col", "is_total"),
                    date_from=date_from, date_to=date_to)
    return rfm_features(base)
