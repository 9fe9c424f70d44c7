"""Cleaning and pseudonymisation of typed invoice rows.

All operators are column rewrites or single aggregates; nothing runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import hashing as H
from ..functions import text as TX


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def convert_types(df: DataFrame) -> DataFrame:
    """date text -> date (invalid -> null); is_total -> (is_total == marker), null stays null."""
    return (df.withColumn("date", TX.parse_day_first_date("date"))
            .withColumn("is_total", F.col("is_total") == F.lit(C.TOTAL_MARKER)))


def vehicle_privacy(df: DataFrame) -> DataFrame:
    """license_plate -> 16 hex of SHA-1, vin -> 20 hex of SHA-1; null or '' -> null."""
    return (df.withColumn("license_plate", H.plate_hash("license_plate"))
            .withColumn("vin", H.vin_hash("vin")))


def clean_amounts(df: DataFrame) -> DataFrame:
    """Flip the sign of every amount, make negative totals positive, drop balance."""
    return (df.withColumn("amount", -F.col("amount"))
            .withColumn("total", F.when(F.col("total") < 0, -F.col("total")).otherwise(F.col("total")))
            .drop("balance"))


def split_customer_name(df: DataFrame, sep: str = C.NAME_SEPARATOR) -> DataFrame:
    """name -> customer_number + customer_description (split on the first separator)."""
    number, desc = TX.split_name("name", sep)
    return df.withColumn("customer_number", number).withColumn("customer_description", desc).drop("name")


def exclude_walk_in(df: DataFrame, walk_in: str = C.WALK_IN_CUSTOMER) -> DataFrame:
    """Rows whose customer number is not the walk-in account (null numbers drop out too)."""
    return df.where(F.col("customer_number") != F.lit(walk_in))


def first_per_key(df: DataFrame, key: str, order: str, cols: Iterable[str]) -> DataFrame:
    """The row with the smallest ``order`` per ``key`` -> (key, order, *cols).

    ``min_by`` over a struct is a partial aggregate: a hot key is reduced on the map side,
    never gathered into one task.
    """
    cols = list(cols)
    picked = F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order))
    return (df.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.min(order).alias(order), picked.alias("_first"))
            .select(key, order, *[F.col("_first." + c).alias(c) for c in cols]))


def repair_shifted_address(df: DataFrame) -> DataFrame:
    """Four ordered repairs of accidentally shifted address columns (each sees the result
    of the previous one; a null condition counts as false).

    A  street holds a postal code: (company, name, street) move right into
       (name, street, city), company := 'Firma'.
    B  street is neither a street nor a postal code, name not null:
       (company, name) := (name, street).
    C  city looks like a street: (street, city) := (city, other), other := null.
    D  other holds a postal code: city := other, other := null.
    """
    co, na, st, ci, ot = (F.col(c) for c in C.ADDRESS_COLUMNS)
    postal = C.POSTAL_CODE_PATTERN
    street = "(?U)" + C.STREET_PATTERN

    def cond(x: Column) -> Column:
        return F.coalesce(x, F.lit(False))

    a = cond(st.rlike(postal))
    df = df.select(*[c for c in df.columns if c not in C.ADDRESS_COLUMNS],
                   F.when(a, F.lit(C.REPAIR_COMPANY_PLACEHOLDER)).otherwise(co).alias("address_company"),
                   F.when(a, co).otherwise(na).alias("address_name"),
                   F.when(a, na).otherwise(st).alias("address_street_house_number"),
                   F.when(a, st).otherwise(ci).alias("address_postal_code_city"),
                   ot.alias("address_other"))
    co, na, st, ci, ot = (F.col(c) for c in C.ADDRESS_COLUMNS)
    not_street = cond(~st.rlike(street) & st.isNotNull() & ~st.rlike(postal))
    street_in_city = cond(ci.rlike(street) & ci.isNotNull())
    b = not_street & na.isNotNull()
    df = df.select(*[c for c in df.columns if c not in C.ADDRESS_COLUMNS],
                   F.when(b, na).otherwise(co).alias("address_company"),
                   F.when(b, st).otherwise(na).alias("address_name"),
                   F.when(street_in_city, ci).otherwise(st).alias("address_street_house_number"),
                   F.when(street_in_city, ot).otherwise(ci).alias("address_postal_code_city"),
                   F.when(street_in_city, F.lit(None).cast("string")).otherwise(ot).alias("address_other"))
    ci, ot = F.col("address_postal_code_city"), F.col("address_other")
    d = cond(ot.rlike(postal))
    return (df.withColumn("address_postal_code_city", F.when(d, ot).otherwise(ci))
            .withColumn("address_other", F.when(d, F.lit(None).cast("string")).otherwise(ot)))


def match_key(df: DataFrame, company: str = "address_company", name: str = "address_name",
              out: str = "address") -> DataFrame:
    """Match key: normalised (company + ' ' + name); null when both are null."""
    return df.withColumn(out, TX.normalise_key(TX.address_key(company, name)))


def walk_in_union(cleaned: DataFrame, filtered_out: DataFrame, mode: str = "drop",
                  walk_in: str = C.WALK_IN_CUSTOMER) -> DataFrame:
    """Give the walk-in account a fixed customer id.

    ``drop`` (default, reproduces the source behaviour): the walk-in rows were removed
    before, so the appended set is empty. ``keep``: walk-in rows from ``filtered_out`` are
    appended with ``customer_id = walk_in``.
    """
    src = cleaned if mode == "drop" else filtered_out
    walk = src.where(F.col("customer_number") == F.lit(walk_in)).withColumn("customer_id", F.lit(walk_in))
    return cleaned.unionByName(walk.select(*cleaned.columns))


def customer_privacy(df: DataFrame, hash_customer_number: bool = False) -> DataFrame:
    """Drop address columns and the customer description (optionally hash the number)."""
    out = df.drop(*C.ADDRESS_COLUMNS, "customer_description")
    if hash_customer_number:
        out = out.withColumn("customer_number", H.customer_hash("customer_number"))
    return out


def attach_customer_id(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """Every invoice row with the ``customer_id`` of its ``customer_number`` (unique in ``customers``); null where
    the number is unknown or null."""
    return invoices.join(customers.select("customer_number", "customer_id"), "customer_number", "left")
