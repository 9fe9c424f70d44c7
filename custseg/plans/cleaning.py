"""Raw exports -> cleaned, pseudonymised invoice rows (16 columns).

One lazy plan from the text scan to the output; the distinct-customer table used for
identity resolution is the only intermediate that is checkpointed (inside the resolver).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C
from ..operators import clean
from ..operators.resolve import resolve_components, resolve_ordered
from ..sources import raw_text


@dataclass
class CleanResult:
    invoices: DataFrame
    quarantine: DataFrame
    customers: DataFrame      # customer_number -> customer_id (+ match key)
    export: raw_text.RawExport    # its ingest_counts are known when the quarantine is written


def clean_exports(spark: SparkSession, data_dir: str, suffixes=tuple(C.RAW_FILE_SUFFIXES),
                  encoding: str = C.RAW_ENCODING, strip: str = "both", walk_in: str = "drop",
                  use_repaired_address: bool = False, hash_customer_number: bool = False,
                  strict_numbers: bool = True, cutoff: int = C.SIMILARITY_CUTOFF,
                  grouping: str = "components") -> CleanResult:
    """``grouping``: ``components`` (transitive groups, the stated intent) or ``ordered``
    (the source pipeline's order-dependent groups, where later groups take members)."""
    export = raw_text.read_raw_export(spark, data_dir, suffixes, encoding, strip)
    df = clean_rows(export.rows, strict_numbers)
    customers = customer_ids(df, use_repaired_address, cutoff, grouping)
    kept = clean.exclude_walk_in(df)
    joined = clean.attach_customer_id(kept, customers)
    with_walk_in = clean.walk_in_union(joined, df, mode=walk_in)
    out = clean.customer_privacy(with_walk_in, hash_customer_number)
    cols = ["date", "invoice_num", "license_plate", "mileage", "vin", "manufacturer", "type",
            "first_registration", "item_id", "item_description", "is_total", "amount", "price",
            "total", "customer_number", "customer_id"]
    return CleanResult(out.select(*cols), export.quarantine, customers, export)


def clean_rows(rows: DataFrame, strict_numbers: bool = True) -> DataFrame:
    """Split export rows (ordinal, fields) -> typed rows with dates, flags, hashed vehicles, signs and
    the customer number; nothing about other rows is needed, so nothing is shuffled."""
    df = clean.convert_types(raw_text.typed_invoices(rows, strict_numbers))
    return clean.split_customer_name(clean.clean_amounts(clean.vehicle_privacy(df)))


def customer_ids(df: DataFrame, use_repaired_address: bool = False,
                 cutoff: int = C.SIMILARITY_CUTOFF, grouping: str = "components") -> DataFrame:
    """customer_number -> customer_id: the first row per number (file order), its match key,
    fuzzy grouping of keys, SHA-256 of the group's earliest key."""
    first = clean.first_per_key(clean.exclude_walk_in(df), "customer_number", "ordinal", C.ADDRESS_COLUMNS)
    if use_repaired_address:
        first = clean.repair_shifted_address(first)
    keyed = clean.match_key(first)
    if grouping == "ordered":
        return resolve_ordered(keyed, "customer_number", "address", "ordinal", cutoff)
    if grouping != "components":
        raise ValueError("grouping must be 'components' or 'ordered'")
    return resolve_components(keyed, "customer_number", "address", "ordinal", cutoff)
