"""Cleaned invoices -> RFM features (Parquet in, Parquet out)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C
from ..operators import rfm
from ..sources import tables


def rfm_job(spark: SparkSession, cleaned_path: str, out_path: str | None = None, date_from=None,
            date_to=None, excluded_ids=C.EXCLUDED_ITEM_IDS) -> DataFrame:
    df = tables.read_parquet(spark, cleaned_path)
    out = rfm.rfm_from_invoices(df, date_from, date_to, excluded_ids)
    if out_path:
        tables.write_parquet(out, out_path)
    return out
