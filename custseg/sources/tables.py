"""Parquet tables: scan, sink, and the adapters that present the TPC-H-like test tables
in the shape of the invoice pipeline (orders = invoice totals, lineitem = invoice items)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as TX


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("sep", sep).option("header", header).option("encoding", "UTF-8").csv(path)
    return path


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = ";", header: bool = True,
             quotes: bool = False) -> DataFrame:
    """A separated text table as strings; ``quotes`` decides whether quote characters delimit fields or are
    text like any other. With ``columns`` the file's own header, if any, is replaced by those names."""
    reader = spark.read.option("sep", sep).option("header", header).option("quote", '"' if quotes else "\0")
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(path)


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as export files: one file per document, its lines with their ordinals."""
    docs = read_table(spark, sf_dir, "documents")
    lines = docs.select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("file"),
                        F.posexplode(F.split("text", "\n", -1)).alias("row", "line"))
    return lines.select("file", F.struct("file", "row").alias("ordinal"), (F.col("row") == 0).alias("is_file_header"), "line")


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders, lineitem and customer rendered as the 21 tab-separated columns of a raw export: a
    row per item and a total row per invoice, in one frame of split lines (ordinal, fields)."""
    def money(c):
        return TX.format_locale_number(c, 2)

    o = read_table(spark, sf_dir, "orders").join(
        read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    key = F.col("o_custkey")
    common = {
        "date": F.date_format("o_orderdate", "dd.MM.yyyy"), "invoice_num": F.col("o_orderkey").cast("string"),
        "name": F.concat(key.cast("string"), F.lit(" - "), F.coalesce("c_name", F.lit("?"))),
        "license_plate": F.when(key % 5 != 0, F.concat(F.lit("LP "), (key % 97).cast("string"))),
        "vin": F.concat(F.lit("V"), F.col("o_orderkey").cast("string")), "manufacturer": F.col("c_mktsegment"),
        "address_company": F.when(key % 3 == 0, F.col("c_name")),
        "address_street_house_number": F.concat(F.lit("Str. "), (key % 100).cast("string")),
        "address_postal_code_city": F.concat(F.lpad((key % 100000).cast("string"), 5, "0"), F.lit(" City"))}
    totals = o.select(*[v.alias(k) for k, v in common.items()], F.lit(C.TOTAL_MARKER).alias("is_total"),
                      money(F.when(key % 2 == 1, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))).alias("total"),
                      F.lit(0).alias("line"))
    items = o.join(read_table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(
        *[v.alias(k) for k, v in common.items()], F.col("l_partkey").cast("string").alias("item_id"),
        money(F.col("l_quantity")).alias("amount"), money(F.col("l_extendedprice")).alias("price"),
        F.col("l_linenumber").alias("line"))
    rows = totals.unionByName(items, allowMissingColumns=True).repartition("invoice_num", "line")
    have = set(rows.columns)
    cells = [F.coalesce(F.col(c), F.lit("")) if c in have else F.lit("0" if c == "balance" else "") for c in C.RAW_COLUMNS]
    return rows.select(F.lit("orders").alias("file"), F.struct("invoice_num", "line").alias("ordinal"),
                       F.lit(False).alias("is_file_header"), F.concat_ws("\t", *cells).alias("line"))


def invoice_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as invoice total rows: (invoice_num, customer_id, date, total, is_total)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("invoice_num"),
                    F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderdate").alias("date"),
                    F.col("o_totalprice").alias("total"),
                    F.lit(True).alias("is_total"))


def invoice_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as invoice item rows: (invoice_num, item_id)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("invoice_num"), F.col("l_partkey").alias("item_id"))
