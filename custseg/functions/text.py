"""String Column expressions (all JVM built-ins, inside whole-stage codegen)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """Remove leading and trailing whitespace as Python's ``str.strip()`` does
    (Unicode spaces and control separators, not only blanks)."""
    return F.btrim(_c(c), F.lit(C.PY_WHITESPACE))


def py_strip_newline(c: str | Column) -> Column:
    """Remove only trailing line-break characters."""
    return F.regexp_replace(_c(c), "[\\r\\n]+$", "")


def normalise_line(c: str | Column, strip: str = "both") -> Column:
    """Raw export line -> line ready to split: strip, middle dot -> '-', ';' -> '/'."""
    col = _c(c)
    if strip == "both":
        col = py_strip(col)
    elif strip == "newline":
        col = py_strip_newline(col)
    elif strip != "none":
        raise ValueError(f"strip must be both|newline|none, not {strip!r}")
    for old, new in ((C.MIDDLE_DOT, "-"), (C.CSV_SEPARATOR, "/")):      # most lines hold neither: a scan, no rewriting
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def split_fields(c: str | Column, sep: str = C.FIELD_SEPARATOR) -> Column:
    """Split on a literal separator, keeping empty trailing fields."""
    return F.split(_c(c), re.escape(sep), -1)


def null_if_na(c: str | Column, na_strings: Iterable[str] = C.NA_STRINGS) -> Column:
    col = _c(c)
    return F.when(~col.isin(list(na_strings)), col)


def parse_day_first_date(c: str | Column, fmt: str = C.DATE_FORMAT) -> Column:
    """'1.2.2020' -> 2020-02-01; invalid calendar dates ('31.02.2020') and junk -> null."""
    return F.try_to_date(_c(c), fmt)


def parse_locale_number(c: str | Column, thousands: str = ".", decimal: str = ",",
                        strict: bool = True) -> Column:
    """'1.234,56' -> 1234.56. ``strict`` raises on junk (ANSI cast), else null."""
    col = F.replace(_c(c), F.lit(thousands), F.lit(""))
    col = F.replace(col, F.lit(decimal), F.lit("."))
    return col.cast("double") if strict else col.try_cast("double")


def format_locale_number(c: str | Column, digits: int = 2) -> Column:
    """1234.56 -> '1.234,56' (inverse of :func:`parse_locale_number`)."""
    return F.translate(F.format_number(_c(c), digits), ",.", ".,")


def split_name(c: str | Column, sep: str = C.NAME_SEPARATOR) -> tuple[Column, Column]:
    """Split on the first separator: (before, after); no separator -> (whole, null)."""
    parts = F.split(_c(c), re.escape(sep), 2)
    return F.get(parts, 0), F.get(parts, 1)


def address_key(company: str | Column, name: str | Column) -> Column:
    """company + ' ' + name, nulls as ''; null when both are null."""
    co, na = _c(company), _c(name)
    return F.when(co.isNotNull() | na.isNotNull(),
                  F.concat(F.coalesce(co, F.lit("")), F.lit(" "), F.coalesce(na, F.lit(""))))


def normalise_key(c: str | Column, salutations: Iterable[str] = C.KEY_SALUTATIONS) -> Column:
    """lower-case, delete each salutation literal anywhere (in order), strip."""
    col = F.lower(_c(c))
    for s in salutations:
        col = F.replace(col, F.lit(s), F.lit(""))
    return py_strip(col)
