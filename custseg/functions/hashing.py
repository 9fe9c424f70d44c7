"""Pseudonymisation hashes as built-in Column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sha1_prefix(c: str | Column, n: int) -> Column:
    """First ``n`` hex chars of SHA-1 of the UTF-8 text; null or '' -> null."""
    col = _c(c)
    return F.when(F.length(col) > 0, F.substring(F.sha1(col), 1, n))


def plate_hash(c: str | Column) -> Column:
    return sha1_prefix(c, C.PLATE_HASH_CHARS)


def vin_hash(c: str | Column) -> Column:
    return sha1_prefix(c, C.VIN_HASH_CHARS)


def customer_hash(c: str | Column) -> Column:
    """SHA-256 hex of the UTF-8 text; null -> null."""
    return F.sha2(_c(c), 256)
