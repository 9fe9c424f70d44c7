"""Raw invoice exports: tab-separated text files in a legacy charset, one header per file.

The files are read by one distributed text scan. No merged intermediate file is written:
the "merge" is the scan over all matching files, and the line order needed later
(first row per customer, order-dependent grouping) comes from a source ordinal
``(file_name, file_block_start, monotonically_increasing_id)`` computed on the scan itself,
before any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as TX


class EmptyInputError(Exception):
    """No input file is left after filtering by suffix."""


_ENCODINGS = {
    "iso8859_15": "latin9", "iso-8859-15": "latin9", "latin9": "latin9", "latin-9": "latin9",
    "iso8859_1": "latin1", "iso-8859-1": "latin1", "latin1": "latin1", "latin-1": "latin1",
    "utf-8": "utf8", "utf8": "utf8",
}


def _glob_for(suffixes) -> str:
    if not suffixes:
        return "*"
    if len(suffixes) == 1:
        return "*" + suffixes[0]
    return "*{" + ",".join(suffixes) + "}"


def decode_line(value, encoding: str):
    """Bytes of a text line (kept raw by the text source) -> Unicode string."""
    kind = _ENCODINGS.get(encoding.lower())
    if kind is None:
        raise ValueError(f"unsupported encoding {encoding!r}")
    if kind == "utf8":
        return value
    latin1 = F.decode(value.cast("binary"), "ISO-8859-1")
    if kind == "latin1":
        return latin1
    return F.translate(latin1, C.LATIN1_CHARS_REPLACED_BY_LATIN9, C.LATIN9_CHARS)


def read_raw_lines(spark: SparkSession, data_dir: str, suffixes=tuple(C.RAW_FILE_SUFFIXES),
                   encoding: str = C.RAW_ENCODING) -> DataFrame:
    """Lines of every matching file directly in ``data_dir`` (not recursive; suffix is
    case-sensitive; no suffix filter when ``suffixes`` is empty).

    Columns: ``file`` (name), ``ordinal`` struct(file, block, row) giving the file order
    then the line order, ``is_file_header`` and ``line`` (decoded).
    Raises :class:`EmptyInputError` when no file matches.
    """
    reader = spark.read.format("text").option("pathGlobFilter", _glob_for(list(suffixes or [])))
    try:
        raw = reader.load(data_dir)
    except AnalysisException as e:
        if e.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise EmptyInputError(f"no file matching {suffixes} in {data_dir}") from e
        raise
    if not raw.inputFiles():
        raise EmptyInputError(f"no file matching {suffixes} in {data_dir}")
    with_ord = raw.select(
        # the name is URI-encoded (%20 for a blank); decode %XX only, keeping a literal '+'
        F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value"))
    lines = with_ord.select(
        "file", F.struct("file", "block", "row").alias("ordinal"),
        decode_line(F.col("value"), encoding).alias("line"))
    # first line of each file = smallest ordinal in its first block; one row per file, and the driver
    # already holds the list of files, so the table is small enough to broadcast
    heads = lines.where(F.col("ordinal.block") == 0).groupBy("file").agg(F.min("ordinal.row").alias("_head"))
    return (lines.join(F.broadcast(heads), "file", "left")
            .select("file", "ordinal",
                    ((F.col("ordinal.block") == 0) & (F.col("ordinal.row") == F.col("_head"))).alias("is_file_header"),
                    "line"))


def split_lines(lines: DataFrame, strip: str = "both", sep: str = C.FIELD_SEPARATOR) -> DataFrame:
    """Normalise each line and split it into fields -> adds ``fields`` and ``n_fields``."""
    fields = TX.split_fields(TX.normalise_line(F.col("line"), strip), sep)
    return lines.withColumn("fields", fields).withColumn("n_fields", F.size("fields"))


@dataclass
class RawExport:
    header: DataFrame       # the first file's header line (one row)
    rows: DataFrame         # data lines with the header's field count
    quarantine: DataFrame   # data lines with another field count
    seen: Observation       # data lines and kept ones, counted by the first job over the quarantine
    width: int              # the header's field count


def read_raw_export(spark: SparkSession, data_dir: str, suffixes=tuple(C.RAW_FILE_SUFFIXES),
                    encoding: str = C.RAW_ENCODING, strip: str = "both") -> RawExport:
    """Scan, drop every file's header (keeping the first file's), split, separate ragged rows."""
    return export_of_lines(read_raw_lines(spark, data_dir, suffixes, encoding), strip)


def export_of_lines(lines: DataFrame, strip: str = "both", sep: str = C.FIELD_SEPARATOR) -> RawExport:
    """The export that ``lines`` (file, ordinal, is_file_header, line) hold. The first file's header is
    read once; its width is a literal of the filters, so rows and quarantine are one scan each."""
    lines = split_lines(lines, strip, sep)
    headers = lines.where("is_file_header")
    first = headers.orderBy("ordinal").limit(1)
    row = first.select("n_fields").first()
    width = F.lit(row["n_fields"] if row else 0)
    seen = Observation()
    data = lines.where(~F.col("is_file_header"))
    # only there: what reads the rows may sort or join them, and Spark counts what such plans run twice twice
    counted = data.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("n_fields") == width, 1)).alias("kept"))
    return RawExport(header=first, rows=data.where(F.col("n_fields") == width),
                     quarantine=counted.where(F.col("n_fields") != width), seen=seen, width=row["n_fields"] if row else 0)


def ingest_counts(export: RawExport) -> dict:
    """Header width, lines (with the first header), data lines kept and removed: counted by the job that has
    written the quarantine, without a scan of their own. Call it after that job; before it waits for it."""
    seen = export.seen.get
    return {"columns": export.width, "rows": seen["rows"] + 1, "kept": seen["kept"], "removed": seen["rows"] - seen["kept"]}


def typed_invoices(rows: DataFrame, strict_numbers: bool = True) -> DataFrame:
    """Positional fields -> the 21 named columns: NA strings -> null, numbers parsed with
    '.' thousands and ',' decimals (date parsing and flags are cleaning steps)."""
    cols = []
    for i, name in enumerate(C.RAW_COLUMNS):
        v = TX.null_if_na(F.get(F.col("fields"), i))
        if name in C.NUMERIC_COLUMNS:
            v = TX.parse_locale_number(v, strict=strict_numbers)
        cols.append(v.alias(name))
    return rows.select("ordinal", *cols)
