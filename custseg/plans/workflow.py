"""The whole job: raw exports -> cleaned invoices -> RFM features -> segments, model and run table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import constants as C
from ..sources import raw_text, tables
from .cleaning import clean_exports
from .features import rfm_job
from .training import TrainResult, train, write_run


def run_all(spark: SparkSession, raw_dir: str, out_dir: str, run_id: str, date_from=None, date_to=None,
            excluded_ids=C.EXCLUDED_ITEM_IDS, clean_options: dict | None = None,
            train_options: dict | None = None) -> TrainResult:
    """Below ``out_dir``: ``invoices``, ``quarantine`` and ``features`` (replaced), then the sinks of
    ``training.write_run``. Each step reads what the one before has written; errors stop the job."""
    cleaned = clean_exports(spark, raw_dir, **(clean_options or {}))
    tables.write_parquet(cleaned.invoices, f"{out_dir}/invoices")
    tables.write_parquet(cleaned.quarantine.drop("ordinal"), f"{out_dir}/quarantine")
    counts = raw_text.ingest_counts(cleaned.export)
    rfm_job(spark, f"{out_dir}/invoices", f"{out_dir}/features", date_from, date_to, excluded_ids)
    result = train(tables.read_parquet(spark, f"{out_dir}/features"), **(train_options or {}))
    result.metrics.update({f"ingest_{name}": n for name, n in counts.items()})
    write_run(result, out_dir, run_id)
    return result
