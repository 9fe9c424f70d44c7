"""Registered queries over the test tables and their DuckDB oracle SQL.

Each query reads whole tables (no id subsets, no row caps) and returns a DataFrame whose
column names equal the oracle's. Floating results are rounded to fixed digits in both
engines so order-insensitive hashes compare values, not summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import rfm
from ..session import materialise
from ..sources import raw_text as RT
from ..sources import tables as T
from .cleaning import clean_rows

# Parameters of the test-table queries (chosen once; the same in Spark and in SQL).
EXCLUDED_PARTS = [7, 42, 111, 200, 333, 1109]
WINDOW_FROM = "1995-06-01"
WINDOW_TO = "2001-06-30"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql.strip()
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# ---------------------------------------------------------------------------
# RFM on orders (customer = o_custkey, day = o_orderdate, total = o_totalprice,
# excluded invoices = orders with a lineitem of an excluded part)
# ---------------------------------------------------------------------------

def kept_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.exclude_invoices(T.invoice_totals(spark, sf_dir), EXCLUDED_PARTS,
                                items=T.invoice_items(spark, sf_dir))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_base(kept_invoices(spark, sf_dir), date_from=WINDOW_FROM, date_to=WINDOW_TO)


def rfm_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM of orders; sums are rounded to 6 decimals on both sides, as their order differs."""
    return rfm.rfm_features(visits(spark, sf_dir)).withColumn("monetary", F.round("monetary", 6))


_parts = ", ".join(str(p) for p in EXCLUDED_PARTS)
SQL_KEPT = f"""
kept AS (
  SELECT o.o_orderkey AS invoice_num, o.o_custkey AS customer_id, o.o_orderdate AS date,
         o.o_totalprice AS total
  FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l
                    WHERE l.l_partkey IN ({_parts})
                      AND l.l_orderkey IS NOT DISTINCT FROM o.o_orderkey))"""
SQL_VISITS = SQL_KEPT + f""",
visits AS (
  SELECT customer_id, CAST(date AS DATE) AS date,
         COALESCE(SUM(total), 0) AS total
  FROM kept
  WHERE CAST(date AS DATE) BETWEEN DATE '{WINDOW_FROM}' AND DATE '{WINDOW_TO}'
    AND customer_id IS NOT NULL
  GROUP BY 1, 2)"""
SQL_RFM = SQL_VISITS + """,
per AS (
  SELECT customer_id, MAX(date) AS last_visit, COUNT(date) AS frequency, SUM(total) AS monetary
  FROM visits GROUP BY 1),
rfm AS (
  SELECT customer_id,
         CAST(date_diff('day', last_visit, (SELECT MAX(date) FROM visits)) AS INTEGER) AS recency,
         frequency, round(monetary, 6) AS monetary
  FROM per WHERE frequency <> 1)"""


@register("rfm_features", "WITH " + SQL_RFM + "\nSELECT * FROM rfm")
def q_rfm_features(spark, sf_dir):
    return rfm_orders(spark, sf_dir)


@register("exclude_invoices", "WITH " + SQL_KEPT + "\nSELECT * FROM kept")
def q_exclude_invoices(spark, sf_dir):
    return kept_invoices(spark, sf_dir).select("invoice_num", "customer_id", "date", "total")


@register("same_day_totals",
          "WITH " + SQL_VISITS + "\nSELECT customer_id, date, round(total, 6) AS total FROM visits")
def q_same_day_totals(spark, sf_dir):
    return visits(spark, sf_dir).select("customer_id", "date", F.round("total", 6).alias("total"))


@register("recency", "WITH " + SQL_VISITS + """
SELECT customer_id,
       CAST(date_diff('day', MAX(date), (SELECT MAX(date) FROM visits)) AS INTEGER) AS recency
FROM visits GROUP BY 1""")
def q_recency(spark, sf_dir):
    return rfm.recency(visits(spark, sf_dir))


@register("frequency", "WITH " + SQL_VISITS + """
SELECT customer_id, COUNT(date) AS frequency FROM visits GROUP BY 1 HAVING COUNT(date) <> 1""")
def q_frequency(spark, sf_dir):
    return rfm.frequency(visits(spark, sf_dir))


@register("monetary", "WITH " + SQL_VISITS + """
SELECT customer_id, round(SUM(total), 6) AS monetary FROM visits GROUP BY 1""")
def q_monetary(spark, sf_dir):
    return rfm.monetary(visits(spark, sf_dir)).withColumn("monetary", F.round("monetary", 6))


# ---------------------------------------------------------------------------
# Cleaning and pseudonymisation on test tables
# ---------------------------------------------------------------------------
from ..functions import hashing as H  # noqa: E402
from ..functions import text as TX  # noqa: E402
from ..operators import clean  # noqa: E402

# Python's str.isspace() set as an RE2 character-class body (DuckDB side).
RE2_PY_WHITESPACE = ("\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
                     "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}")


def _sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^[{RE2_PY_WHITESPACE}]+|[{RE2_PY_WHITESPACE}]+$', '', 'g')"


@register("pseudonymise", """
SELECT c_custkey,
       CASE WHEN length(c_name) > 0 THEN substr(sha1(c_name), 1, 16) END AS license_plate,
       CASE WHEN length(c_mktsegment) > 0 THEN substr(sha1(c_mktsegment), 1, 20) END AS vin,
       sha256(c_name) AS customer_id
FROM customer""")
def q_pseudonymise(spark, sf_dir):
    c = T.read_table(spark, sf_dir, "customer")
    return c.select("c_custkey", H.plate_hash("c_name").alias("license_plate"),
                    H.vin_hash("c_mktsegment").alias("vin"),
                    H.customer_hash("c_name").alias("customer_id"))


@register("keep_first", """
SELECT o_custkey, min(o_orderkey) AS o_orderkey,
       arg_min(CAST(o_orderdate AS DATE), o_orderkey) AS o_orderdate,
       arg_min(o_totalprice, o_orderkey) AS o_totalprice
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey""")
def q_keep_first(spark, sf_dir):
    o = T.read_table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return clean.first_per_key(o, "o_custkey", "o_orderkey", ["o_orderdate", "o_totalprice"])


@register("split_name", """
SELECT doc_id,
       CASE WHEN strpos(text, '. ') > 0 THEN substr(text, 1, strpos(text, '. ') - 1) ELSE text END
         AS customer_number,
       CASE WHEN strpos(text, '. ') > 0 THEN substr(text, strpos(text, '. ') + 2) END
         AS customer_description
FROM documents""")
def q_split_name(spark, sf_dir):
    d = T.read_table(spark, sf_dir, "documents")
    number, desc = TX.split_name("text", ". ")
    return d.select("doc_id", number.alias("customer_number"), desc.alias("customer_description"))


@register("normalise_key", f"""
SELECT doc_id,
       CASE WHEN source IS NOT NULL OR text IS NOT NULL THEN
         {_sql_strip("replace(replace(replace(lower(coalesce(source, '') || ' ' || coalesce(text, '')), 'herr ', ''), 'frau ', ''), 'herrn ', '')")}
       END AS address
FROM documents""")
def q_normalise_key(spark, sf_dir):
    d = T.read_table(spark, sf_dir, "documents")
    return d.select("doc_id", TX.normalise_key(TX.address_key("source", "text")).alias("address"))


LINE_SEP_FOR_TEST = ","


def _sql_norm_line(expr: str) -> str:
    return f"translate({_sql_strip(expr)}, '·;', '-/')"


@register("line_normalise", f"""
WITH l AS (
  SELECT doc_id, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no,
         unnest(string_split(text, chr(10))) AS raw
  FROM documents)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
       array_to_string(string_split({_sql_norm_line("raw")}, '{LINE_SEP_FOR_TEST}'), ';') AS line_csv,
       CAST(len(string_split({_sql_norm_line("raw")}, '{LINE_SEP_FOR_TEST}')) AS INTEGER) AS n_fields
FROM l""")
def q_line_normalise(spark, sf_dir):
    d = T.read_table(spark, sf_dir, "documents")
    lines = d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "raw"))
    fields = TX.split_fields(TX.normalise_line(F.col("raw")), LINE_SEP_FOR_TEST)
    return lines.select("doc_id", "line_no", F.concat_ws(";", fields).alias("line_csv"),
                        F.size(fields).alias("n_fields"))


SQL_LINES = f"""l AS (
  SELECT doc_id, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS file,
         unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no,
         unnest(string_split(text, chr(10))) AS raw
  FROM documents),
f AS (SELECT file, line_no, {_sql_norm_line("raw")} AS line,
             len(string_split({_sql_norm_line("raw")}, '{LINE_SEP_FOR_TEST}')) AS n FROM l),
h AS (SELECT n AS n_header FROM f WHERE line_no = 0 ORDER BY file LIMIT 1)"""


@register("ragged_rows", "WITH " + SQL_LINES + """
SELECT file, any_value(n_header) AS n_columns, count(*) FILTER (WHERE n = n_header) AS kept,
       count(*) FILTER (WHERE n <> n_header) AS removed
FROM f, h WHERE line_no > 0 GROUP BY file""")
def q_ragged_rows(spark, sf_dir):
    """Per document (= one export file): data lines kept and quarantined against the first file's header."""
    export = RT.export_of_lines(T.document_lines(spark, sf_dir), sep=LINE_SEP_FOR_TEST)
    width = export.header.select("n_fields").first()
    both = export.rows.select("file", F.lit(1).alias("k")).unionByName(export.quarantine.select("file", F.lit(0).alias("k")))
    return both.groupBy("file").agg(F.sum("k").alias("kept"), F.sum(1 - F.col("k")).alias("removed")) \
        .withColumn("n_columns", F.lit(width["n_fields"] if width else 0).cast("long"))


@register("header_rows", "WITH " + SQL_LINES + """
SELECT file, line, n AS n_fields, file = (SELECT min(file) FROM f) AS is_first FROM f WHERE line_no = 0""")
def q_header_rows(spark, sf_dir):
    """Every file's header line, normalised, and which of them names the columns."""
    lines = T.document_lines(spark, sf_dir)
    first = RT.export_of_lines(lines, sep=LINE_SEP_FOR_TEST).header.select(F.col("file").alias("_first"))
    heads = RT.split_lines(lines.where("is_file_header"), sep=LINE_SEP_FOR_TEST)
    return heads.join(F.broadcast(first), F.col("file") == F.col("_first"), "left").select(
        "file", TX.normalise_line("line").alias("line"), F.col("n_fields").cast("long").alias("n_fields"),
        F.col("_first").isNotNull().alias("is_first"))


@register("ingest_counts", "WITH " + SQL_LINES + """
SELECT any_value(n_header) AS columns, count(*) FILTER (WHERE line_no > 0) + 1 AS "rows",
       count(*) FILTER (WHERE line_no > 0 AND n = n_header) AS kept,
       count(*) FILTER (WHERE line_no > 0 AND n <> n_header) AS removed
FROM f, h""")
def q_ingest_counts(spark, sf_dir):
    """Counts of an ingest, by the job that writes its quarantine."""
    export = RT.export_of_lines(T.document_lines(spark, sf_dir), sep=LINE_SEP_FOR_TEST)
    materialise(export.quarantine, "quarantine")
    counts = RT.ingest_counts(export)
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


def typed_invoice_rows(spark, sf_dir):
    """The rendered export, split. Rows are spread before they are rendered, as the tables are few files; the
    operators read the fields in the same stage, so nothing is written in between. The number, never
    negative, keeps filters on fields above the exchange; below it they would render and split every line twice."""
    once = F.when(F.monotonically_increasing_id() >= 0, F.col("fields")).alias("fields")
    return RT.split_lines(T.invoice_lines(spark, sf_dir)).select("ordinal", once)


SQL_INVOICES = """
cu AS (SELECT o.*, c.c_name, c.c_mktsegment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
inv AS (
  SELECT o_orderkey, o_custkey, o_orderdate, c_name, c_mktsegment, NULL AS item_id, true AS is_total,
         CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS DOUBLE) AS price,
         CASE WHEN o_custkey % 2 = 1 THEN -o_totalprice ELSE o_totalprice END AS total
  FROM cu
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderdate, c_name, c_mktsegment, CAST(l_partkey AS VARCHAR), NULL,
         l_quantity, l_extendedprice, NULL
  FROM cu JOIN lineitem ON l_orderkey = o_orderkey)"""


@register("typed_rows", "WITH " + SQL_INVOICES + """
SELECT strftime(o_orderdate, '%d.%m.%Y') AS date, CAST(o_orderkey AS VARCHAR) AS invoice_num,
       CAST(o_custkey AS VARCHAR) || ' - ' || coalesce(c_name, '?') AS name, c_mktsegment AS manufacturer, item_id,
       CASE WHEN is_total THEN '-SPLITTEN-' END AS is_total, round(amount, 2) AS amount, round(price, 2) AS price,
       round(total, 2) AS total, 0.0 AS balance
FROM inv""")
def q_typed_rows(spark, sf_dir):
    """The rendered export, split and typed again: text, missing strings and locale numbers."""
    t = RT.typed_invoices(typed_invoice_rows(spark, sf_dir))
    return t.select("date", "invoice_num", "name", "manufacturer", "item_id", "is_total",
                    *[F.round(c, 2).alias(c) for c in ("amount", "price", "total", "balance")])


@register("clean_invoices", "WITH " + SQL_INVOICES + """
SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey AS VARCHAR) AS invoice_num,
       CASE WHEN o_custkey % 5 <> 0 THEN substr(sha1('LP ' || CAST(o_custkey % 97 AS VARCHAR)), 1, 16) END AS license_plate,
       substr(sha1('V' || CAST(o_orderkey AS VARCHAR)), 1, 20) AS vin, item_id, is_total,
       round(-amount, 2) AS amount, round(abs(total), 2) AS total, CAST(o_custkey AS VARCHAR) AS customer_number
FROM inv WHERE o_custkey <> 10""")
def q_clean_invoices(spark, sf_dir):
    """Dates, flags, hashed vehicles, signs, customer number, walk-in account dropped."""
    c = clean.exclude_walk_in(clean_rows(typed_invoice_rows(spark, sf_dir)))
    c = clean.customer_privacy(c)
    return c.select("date", "invoice_num", "license_plate", "vin", "item_id", "is_total",
                    F.round("amount", 2).alias("amount"), F.round("total", 2).alias("total"), "customer_number")


@register("rfm_from_invoices", "WITH " + SQL_INVOICES + f""",
bad AS (SELECT DISTINCT o_orderkey FROM inv WHERE item_id IN ({", ".join(f"'{p}'" for p in EXCLUDED_PARTS)})),
vis AS (SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderdate AS DATE) AS date, sum(abs(total)) AS total
        FROM inv WHERE is_total AND o_custkey <> 10 AND o_orderkey NOT IN (SELECT o_orderkey FROM bad)
          AND CAST(o_orderdate AS DATE) BETWEEN DATE '{WINDOW_FROM}' AND DATE '{WINDOW_TO}' GROUP BY 1, 2)
SELECT customer_id, CAST(date_diff('day', max(date), (SELECT max(date) FROM vis)) AS INTEGER) AS recency,
       count(*) AS frequency, round(sum(total), 6) AS monetary
FROM vis GROUP BY 1 HAVING count(*) <> 1""")
def q_rfm_from_invoices(spark, sf_dir):
    """Cleaned rows -> RFM; item and total rows stand in one table, so excluded items remove invoices."""
    c = clean.exclude_walk_in(clean_rows(typed_invoice_rows(spark, sf_dir)))
    # items and totals are both taken from it
    c = materialise(c.select("customer_number", "invoice_num", "date", "total", "is_total", "item_id"), "clean_rows")
    out = rfm.rfm_from_invoices(c, WINDOW_FROM, WINDOW_TO, [str(p) for p in EXCLUDED_PARTS], customer_col="customer_number")
    return out.withColumn("monetary", F.round("monetary", 6))


@register("parse_locale", """
WITH r AS (
  SELECT o_orderkey, strftime(o_orderdate, '%-d.%-m.%Y') AS date_text,
         translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS total_text
  FROM orders)
SELECT o_orderkey, date_text, total_text, try_strptime(date_text, '%d.%m.%Y')::DATE AS date,
       CAST(replace(replace(total_text, '.', ''), ',', '.') AS DOUBLE) AS total
FROM r""")
def q_parse_locale(spark, sf_dir):
    o = T.read_table(spark, sf_dir, "orders")
    r = o.select("o_orderkey", F.date_format("o_orderdate", "d.M.yyyy").alias("date_text"),
                 TX.format_locale_number(F.col("o_totalprice")).alias("total_text"))
    return r.select("o_orderkey", "date_text", "total_text",
                    TX.parse_day_first_date("date_text").alias("date"),
                    TX.parse_locale_number("total_text").alias("total"))


def _derived_addresses(spark, sf_dir) -> DataFrame:
    """Five address columns derived from customer + nation so that each repair case occurs."""
    c = T.read_table(spark, sf_dir, "customer")
    n = T.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    x = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
    k = F.col("c_custkey")
    postal = lambda v: F.concat(F.lpad(v.cast("string"), 5, "0"), F.lit(" "), F.col("n_name"))
    return x.select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("address_company"),
        F.col("c_name").alias("address_name"),
        F.when(F.col("c_nationkey") % 4 == 0, postal(k))
         .when(F.col("c_nationkey") % 4 == 1, F.col("n_name"))
         .otherwise(F.concat(F.col("n_name"), F.lit("str. "), (k % 97 + 1).cast("string")))
         .alias("address_street_house_number"),
        F.when(F.col("c_nationkey") % 3 == 0,
               F.concat(F.col("n_name"), F.lit("weg "), (k % 13 + 1).cast("string")))
         .otherwise(postal(k % 99991)).alias("address_postal_code_city"),
        F.when(F.col("c_nationkey") % 5 == 0, postal((k * 7) % 100000)).alias("address_other"))


_SQL_DERIVED = """
x AS (SELECT * FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
s0 AS (
  SELECT c_custkey,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS co,
    c_name AS na,
    CASE WHEN c_nationkey % 4 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') || ' ' || n_name
         WHEN c_nationkey % 4 = 1 THEN n_name
         ELSE n_name || 'str. ' || CAST(c_custkey % 97 + 1 AS VARCHAR) END AS st,
    CASE WHEN c_nationkey % 3 = 0 THEN n_name || 'weg ' || CAST(c_custkey % 13 + 1 AS VARCHAR)
         ELSE lpad(CAST(c_custkey % 99991 AS VARCHAR), 5, '0') || ' ' || n_name END AS ci,
    CASE WHEN c_nationkey % 5 = 0 THEN lpad(CAST((c_custkey * 7) % 100000 AS VARCHAR), 5, '0') || ' ' || n_name
    END AS ot
  FROM x)"""
_P = "'^[0-9]{5} '"
_S = "'.*[0-9]{1,4}([\\s]{0,1})[a-zA-Z]?[\\s]?$'"


@register("repair_address", "WITH " + _SQL_DERIVED + f""",
s1 AS (
  SELECT c_custkey,
    CASE WHEN coalesce(regexp_matches(st, {_P}), false) THEN 'Firma' ELSE co END AS co,
    CASE WHEN coalesce(regexp_matches(st, {_P}), false) THEN co ELSE na END AS na,
    CASE WHEN coalesce(regexp_matches(st, {_P}), false) THEN na ELSE st END AS st,
    CASE WHEN coalesce(regexp_matches(st, {_P}), false) THEN st ELSE ci END AS ci,
    ot
  FROM s0),
s2 AS (
  SELECT *,
    coalesce(NOT regexp_matches(st, {_S}) AND st IS NOT NULL AND NOT regexp_matches(st, {_P}), false)
      AND na IS NOT NULL AS b,
    coalesce(regexp_matches(ci, {_S}) AND ci IS NOT NULL, false) AS c
  FROM s1),
s3 AS (
  SELECT c_custkey,
    CASE WHEN b THEN na ELSE co END AS co,
    CASE WHEN b THEN st ELSE na END AS na,
    CASE WHEN c THEN ci ELSE st END AS st,
    CASE WHEN c THEN ot ELSE ci END AS ci,
    CASE WHEN c THEN NULL ELSE ot END AS ot
  FROM s2)
SELECT c_custkey, co AS address_company, na AS address_name, st AS address_street_house_number,
  CASE WHEN coalesce(regexp_matches(ot, {_P}), false) THEN ot ELSE ci END AS address_postal_code_city,
  CASE WHEN coalesce(regexp_matches(ot, {_P}), false) THEN NULL ELSE ot END AS address_other
FROM s3""")
def q_repair_address(spark, sf_dir):
    return clean.repair_shifted_address(_derived_addresses(spark, sf_dir))


_SQL_WALK = """
WITH o AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer_number FROM orders),
cleaned AS (SELECT o_orderkey, customer_number, sha256(customer_number) AS customer_id
            FROM o WHERE customer_number <> '10')
SELECT * FROM cleaned
UNION ALL BY NAME
SELECT o_orderkey, customer_number, '10' AS customer_id FROM {src} WHERE customer_number = '10'"""


def _walk(spark, sf_dir, mode):
    o = T.read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer_number"))
    cleaned = clean.exclude_walk_in(o).withColumn("customer_id", H.customer_hash("customer_number"))
    return clean.walk_in_union(cleaned, o, mode=mode)


@register("walk_in_union", _SQL_WALK.format(src="cleaned"))
def q_walk_in_union(spark, sf_dir):
    return _walk(spark, sf_dir, "drop")


@register("walk_in_keep", _SQL_WALK.format(src="o"))
def q_walk_in_keep(spark, sf_dir):
    return _walk(spark, sf_dir, "keep")


# ---------------------------------------------------------------------------
# Fuzzy identity resolution on whole URLs of pages (short free-text keys, like names)
# ---------------------------------------------------------------------------
from ..operators import resolve  # noqa: E402

# LCS length of two strings as a DuckDB list DP (row r: max over i<=j of prev[i], prev[i-1]+eq).
SQL_LCS = """list_reduce(
  list_transform(string_split({a}, ''), lambda c: list_transform(string_split({b}, ''), lambda d: (c = d)::INT)),
  lambda prev, eq: list_transform(range(1, len(eq) + 1), lambda j:
     list_max(list_transform(range(1, j + 1), lambda i: greatest(prev[i], coalesce(prev[i - 1], 0) + eq[i]))))::INT[],
  list_transform(string_split({b}, ''), lambda d: 0)::INT[])[-1]"""

SQL_FUZZY_URL = """
u AS (SELECT url AS k, min(page_id) AS ord FROM pages WHERE url IS NOT NULL GROUP BY url),
p AS (
  SELECT a.k AS key_a, b.k AS key_b, length(a.k) AS la, length(b.k) AS lb
  FROM u a JOIN u b ON a.k < b.k
  WHERE 90 * greatest(length(a.k), length(b.k)) <= 110 * least(length(a.k), length(b.k))
    AND levenshtein(a.k, b.k) * 10 <= length(a.k) + length(b.k)),
s AS (SELECT key_a, key_b, la, lb, """ + SQL_LCS.format(a="key_a", b="key_b") + """ AS lcs FROM p),
m AS (SELECT key_a, key_b, CAST(lcs AS INTEGER) AS lcs, round(200.0 * lcs / (la + lb), 6) AS score
      FROM s WHERE 200 * lcs >= 90 * (la + lb))"""


@register("fuzzy_pairs", "WITH " + SQL_FUZZY_URL + "\nSELECT * FROM m")
def q_fuzzy_pairs(spark, sf_dir):
    return resolve.similar_key_pairs(T.read_table(spark, sf_dir, "pages"), "url")


@register("fuzzy_pairs_segments", "WITH " + SQL_FUZZY_URL + "\nSELECT * FROM m")
def q_fuzzy_pairs_segments(spark, sf_dir):
    return resolve.similar_key_pairs(T.read_table(spark, sf_dir, "pages"), "url", method="segments")


@register("fuzzy_pairs_75", "WITH " + SQL_FUZZY_URL.replace("90 * greatest", "75 * greatest").replace("110 * least", "125 * least")
          .replace("levenshtein(a.k, b.k) * 10 <=", "levenshtein(a.k, b.k) * 4 <=").replace(">= 90 *", ">= 75 *") + "\nSELECT * FROM m")
def q_fuzzy_pairs_75(spark, sf_dir):
    """A cutoff below those that share a bigram for sure."""
    return resolve.similar_key_pairs(T.read_table(spark, sf_dir, "pages"), "url", cutoff=75)


@register("fuzzy_components", "WITH RECURSIVE " + SQL_FUZZY_URL + """,
e AS (SELECT key_a AS s, key_b AS d FROM m UNION SELECT key_b, key_a FROM m),
reach(s, d) AS (SELECT k, k FROM u UNION SELECT r.s, e.d FROM reach r JOIN e ON r.d = e.s),
comp AS (SELECT s AS k, min(d) AS c FROM reach GROUP BY s),
rep AS (SELECT c, arg_min(u.k, u.ord) AS group_key FROM comp JOIN u USING (k) GROUP BY c)
SELECT pages.page_id, pages.url, rep.group_key, sha256(rep.group_key) AS customer_id
FROM pages LEFT JOIN comp ON pages.url = comp.k LEFT JOIN rep USING (c)""")
def q_fuzzy_components(spark, sf_dir):
    pages = T.read_table(spark, sf_dir, "pages").select("page_id", "url")
    return resolve.resolve_components(pages, "page_id", "url", "page_id")


# ---------------------------------------------------------------------------
# Preparation: quantile transform, IQR outliers, scaling (RFM of orders)
# ---------------------------------------------------------------------------
from ..functions import stats as ST  # noqa: E402
from ..operators import prepare  # noqa: E402

FEATS = ["recency", "frequency", "monetary"]
# The oracle fixes 50 quantile levels (valid when the RFM table has >= 50 rows).
LEVELS_50 = prepare.quantile_levels(50, 50)
_LO, _HI = prepare.clip_bounds()


def _sql_qnormal_p(x: str, g: str) -> str:
    refs = ST.sql_list(LEVELS_50)
    nrefs = ST.sql_list([-v for v in reversed(LEVELS_50)])
    fwd = ST.interp_sql(x, g, refs, 50)
    bwd = ST.interp_sql(f"(-{x})", f"list_reverse(list_transform({g}, lambda v: -v))", nrefs, 50)
    return (f"(CASE WHEN {x} - 1e-7 < ({g})[1] THEN 0.0 WHEN {x} + 1e-7 > ({g})[50] THEN 1.0 "
            f"ELSE 0.5 * ({fwd} - {bwd}) END)")


def _sql_z(p: str) -> str:
    return f"greatest(least({ST.ppf_sql(p)}, {_HI!r}), {_LO!r})"


SQL_QNORMAL = SQL_RFM + """,
grid AS (SELECT """ + ", ".join(
    f"quantile_cont(CAST({f} AS DOUBLE), {ST.sql_list(LEVELS_50)}) AS g_{f}" for f in FEATS) + """ FROM rfm),
qp AS (SELECT customer_id, recency, frequency, monetary, """ + ", ".join(
    f"{_sql_qnormal_p(f'CAST({f} AS DOUBLE)', f'g_{f}')} AS p_{f}" for f in FEATS) + """ FROM rfm, grid),
qz AS (SELECT customer_id, recency, frequency, monetary, """ + ", ".join(
    f"{_sql_z(f'p_{f}')} AS z_{f}" for f in FEATS) + " FROM qp)"


def rfm_quantile_normal(spark, sf_dir):
    r = rfm_orders(spark, sf_dir)
    model = prepare.fit_quantile_transform(r, FEATS)
    return prepare.quantile_transform(r, FEATS, model, suffix="_z")


@register("quantile_normal", "WITH " + SQL_QNORMAL + "\nSELECT customer_id, " + ", ".join(
    f"round(z_{f}, 6) + 0.0 AS {f}" for f in FEATS) + " FROM qz")
def q_quantile_normal(spark, sf_dir):
    t = rfm_quantile_normal(spark, sf_dir)
    return t.select("customer_id", *[(F.round(f + "_z", 6) + F.lit(0.0)).alias(f) for f in FEATS])


@register("iqr_filter", "WITH " + SQL_QNORMAL + """,
b AS (SELECT quantile_cont(z_monetary, 0.25) AS q1, quantile_cont(z_monetary, 0.75) AS q3 FROM qz)
SELECT customer_id, recency, frequency, monetary FROM qz, b
WHERE NOT (z_monetary < q1 - 1.5 * (q3 - q1) OR z_monetary > q3 + 1.5 * (q3 - q1))""")
def q_iqr_filter(spark, sf_dir):
    return prepare.remove_outliers(rfm_orders(spark, sf_dir), FEATS, mode="last")


SQL_SCALED = SQL_RFM + """,
sp AS (SELECT """ + ", ".join(
    f"avg(CAST({f} AS DOUBLE)) AS m_{f}, CASE WHEN stddev_pop({f}) > 0 THEN stddev_pop({f}) ELSE 1.0 END AS s_{f}"
    for f in FEATS) + """ FROM rfm),
scaled AS (SELECT customer_id, """ + ", ".join(
    f"round((CAST({f} AS DOUBLE) - m_{f}) / s_{f}, 7) AS {f}" for f in FEATS) + " FROM rfm, sp)"


def rfm_scaled(spark, sf_dir):
    """RFM of orders scaled to mean 0 / population sd 1, rounded to 7 decimals, written once."""
    r = rfm_orders(spark, sf_dir)
    s, _ = prepare.scale_data(r, FEATS)
    return materialise(s.select("customer_id", *[F.round(f, 7).alias(f) for f in FEATS]), "rfm_scaled")


@register("standard_scale", "WITH " + SQL_SCALED + "\nSELECT * FROM scaled")
def q_standard_scale(spark, sf_dir):
    return rfm_scaled(spark, sf_dir)


# ---------------------------------------------------------------------------
# Clustering on scaled RFM of orders; fixed initial centres = the 4 smallest customer ids
# ---------------------------------------------------------------------------
from ..operators import classify as CL  # noqa: E402
from ..operators import cluster as CU  # noqa: E402
from ..operators import summaries as SU  # noqa: E402
from ..operators.score import score  # noqa: E402
from ..sources.model_store import KnnModel  # noqa: E402
from ..operators.exact_split import exact_split  # noqa: E402
from ..operators.knn_join import knn_join  # noqa: E402
from ..operators.silhouette import silhouette as euclidean_silhouette  # noqa: E402

K_FIXED = 4


def _sq_sql(a: str, b: str, cols: list[str]) -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols)


SQL_ASSIGNED = SQL_SCALED + f""",
cen AS (SELECT row_number() OVER (ORDER BY customer_id) - 1 AS cluster, recency, frequency, monetary
        FROM scaled ORDER BY customer_id LIMIT {K_FIXED}),
dd AS (SELECT s.customer_id, c.cluster, {_sq_sql('s', 'c', FEATS)} AS d2 FROM scaled s, cen c),
assigned AS (SELECT customer_id, cluster FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY d2, cluster) AS rn FROM dd) WHERE rn = 1),
lab AS (SELECT s.customer_id, s.recency, s.frequency, s.monetary, CAST(a.cluster AS INTEGER) AS cluster
        FROM scaled s JOIN assigned a USING (customer_id))"""


def labelled_fixed(spark, sf_dir):
    """Scaled RFM with labels from the fixed initial centres (deterministic in both engines)."""
    s = rfm_scaled(spark, sf_dir)
    centres = CU.first_rows_as_centres(s, FEATS, K_FIXED, "customer_id")
    return CU.assign_clusters(s, FEATS, centres)


@register("assign_clusters", "WITH " + SQL_ASSIGNED + "\nSELECT customer_id, cluster FROM lab")
def q_assign_clusters(spark, sf_dir):
    return labelled_fixed(spark, sf_dir).select("customer_id", "cluster")


@register("lloyd_step", "WITH " + SQL_ASSIGNED + "\nSELECT cluster, " + ", ".join(
    f"round(avg({f}), 6) AS {f}" for f in FEATS) + " FROM lab GROUP BY cluster")
def q_lloyd_step(spark, sf_dir):
    s = rfm_scaled(spark, sf_dir)
    centres = CU.first_rows_as_centres(s, FEATS, K_FIXED, "customer_id")
    c = CU.lloyd_step(s, FEATS, centres)
    return c.select("cluster", *[F.round(f, 6).alias(f) for f in FEATS])


def _sql_kmeans() -> str:
    """Lloyd's iteration for every k of the sweep at once: farthest-first centres, then a recursion over
    rounds that carries the centres of the k whose last move was above the tolerance."""
    far = " + ".join(f"(s.{f} - c.{f}) * (s.{f} - c.{f})" for f in FEATS)
    cols = ", ".join(FEATS)
    order = ", ".join(FEATS)
    kmax = max(C.KMEANS_SWEEP)
    out = [f"mid AS MATERIALIZED (SELECT {', '.join(f'round(avg({f}), 9) AS {f}' for f in FEATS)} FROM scaled)",
           f"f0 AS MATERIALIZED (SELECT 0 AS cluster, {', '.join(f's.{f}' for f in FEATS)} FROM scaled s, mid c "
           f"ORDER BY {far}, {', '.join(f's.{f}' for f in FEATS)} LIMIT 1)"]
    for j in range(1, kmax):
        out.append(f"f{j} AS MATERIALIZED (SELECT * FROM f{j - 1} UNION ALL (SELECT {j} AS cluster, {cols} FROM ("
                   f"SELECT {', '.join(f's.{f}' for f in FEATS)}, min({far}) AS d FROM scaled s, f{j - 1} c "
                   f"GROUP BY ALL) ORDER BY d DESC, {order} LIMIT 1))")
    out.append(f"ks AS (SELECT unnest(range(1, {kmax + 1})) AS k)")
    out.append(f"c0 AS MATERIALIZED (SELECT ks.k, f.cluster, {', '.join(f'f.{f}' for f in FEATS)} "
               f"FROM ks JOIN f{kmax - 1} f ON f.cluster < ks.k)")
    near = (f"SELECT c.k, s.customer_id, {', '.join(f'any_value(s.{f}) AS {f}' for f in FEATS)}, "
            f"arg_min(c.cluster, ({far}, c.cluster)) AS cluster, min({far}) AS d "
            "FROM scaled s, {c} c GROUP BY c.k, s.customer_id")
    move = " + ".join(f"(coalesce(m.{f}, c.{f}) - c.{f}) * (coalesce(m.{f}, c.{f}) - c.{f})" for f in FEATS)
    open_ = f"c.round < {C.KMEANS_MAX_ITER} AND c.moved > (SELECT still FROM tolerance)"
    out.append(f"tolerance AS MATERIALIZED (SELECT {C.KMEANS_TOL!r} * ({' + '.join(f'var_pop({f})' for f in FEATS)})"
               f" / {len(FEATS)} AS still FROM scaled)")
    out.append(f"""rounds AS (SELECT 0 AS round, k, cluster, {cols}, CAST('inf' AS DOUBLE) AS moved FROM c0
        UNION ALL
        SELECT c.round + 1, c.k, c.cluster, {', '.join(f'coalesce(m.{f}, c.{f})' for f in FEATS)},
               sum({move}) OVER (PARTITION BY c.k)
        FROM rounds c LEFT JOIN (
            SELECT k, cluster, {', '.join(f'avg({f}) AS {f}' for f in FEATS)}
            FROM ({near.format(c='rounds').replace(' GROUP BY', f' WHERE {open_} GROUP BY')}) GROUP BY k, cluster) m
        ON c.k = m.k AND c.cluster = m.cluster WHERE {open_})""")
    out.append(f"settled AS MATERIALIZED (SELECT k, cluster, {cols} FROM rounds "
               "QUALIFY round = max(round) OVER (PARTITION BY k))")
    out.append(f"km AS MATERIALIZED ({near.format(c='settled')})")
    return ", ".join(out)


SQL_KMEANS = SQL_SCALED + ", " + _sql_kmeans()
_sq_norm = " + ".join(f"{f} * {f}" for f in FEATS)
_dot = " + ".join(f"a.{f} * g.s_{f}" for f in FEATS)
SQL_SILHOUETTE = f"""
kg AS (SELECT k, cluster, count(*) AS n, sum({_sq_norm}) AS q, {", ".join(f"sum({f}) AS s_{f}" for f in FEATS)}
       FROM lk GROUP BY 1, 2),
md AS (SELECT a.k, a.customer_id, a.cluster AS own, g.cluster AS c, g.n,
              ({" + ".join(f"a.{f} * a.{f}" for f in FEATS)}) * g.n - 2 * ({_dot}) + g.q AS total
       FROM lk a JOIN kg g ON a.k = g.k),
ab AS (SELECT k, customer_id, max(CASE WHEN c = own THEN total / nullif(n - 1, 0) END) AS a,
              min(CASE WHEN c <> own THEN total / n END) AS b, max(CASE WHEN c = own THEN n END) AS own_n
       FROM md GROUP BY 1, 2),
sil AS (SELECT k, avg(CASE WHEN own_n <= 1 OR greatest(a, b) <= 0 THEN 0.0 ELSE coalesce((b - a) / greatest(a, b), 0.0) END)
          AS silhouette FROM ab WHERE b IS NOT NULL GROUP BY k)"""


@register("kmeans_fit", "WITH RECURSIVE " + SQL_KMEANS + f"""
SELECT customer_id, CAST(cluster AS INTEGER) AS cluster FROM km WHERE k = {C.KMEANS_K}""")
def q_kmeans_fit(spark, sf_dir):
    _, lab = CU.kmeans_fit(rfm_scaled(spark, sf_dir), FEATS, init="farthest")
    return lab.select("customer_id", "cluster")


@register("kmeans_sweep", "WITH RECURSIVE " + SQL_KMEANS + ", lk AS (SELECT * FROM km), " + SQL_SILHOUETTE + """
SELECT CAST(t.k AS INTEGER) AS k, round(sum(greatest(t.d, 0.0)), 4) AS sse,
       round(any_value(sil.silhouette), 6) AS silhouette_sq
FROM km t LEFT JOIN sil ON t.k = sil.k GROUP BY t.k""")
def q_kmeans_sweep(spark, sf_dir):
    s = CU.kmeans_sweep(rfm_scaled(spark, sf_dir), FEATS, init="farthest")
    return s.select("k", F.round("sse", 4).alias("sse"), F.round("silhouette_sq", 6).alias("silhouette_sq"))


@register("kmeans_parallel")
def q_kmeans_parallel(spark, sf_dir):
    """Sweep from k-means|| seeds; tests/test_cluster.py compares it with a numpy version of both."""
    s = CU.kmeans_sweep(rfm_scaled(spark, sf_dir), FEATS)
    return s.select("k", F.round("sse", 4).alias("sse"), F.round("silhouette_sq", 6).alias("silhouette_sq"))


_dist_cc = " + ".join(f"(l.{f} - c.{f}) * (l.{f} - c.{f})" for f in FEATS)
_dist_ab = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in FEATS)


@register("davies_bouldin", "WITH " + SQL_ASSIGNED + f""",
cc AS (SELECT cluster, {", ".join(f"avg({f}) AS {f}" for f in FEATS)} FROM lab GROUP BY cluster),
dbs AS (SELECT l.cluster, avg(sqrt({_dist_cc})) AS s FROM lab l JOIN cc c USING (cluster) GROUP BY l.cluster),
dbp AS (SELECT cc.*, dbs.s FROM cc JOIN dbs USING (cluster)),
pr AS (SELECT a.cluster AS i, CASE WHEN sqrt({_dist_ab}) = 0 THEN 0.0
                                   ELSE (a.s + b.s) / sqrt({_dist_ab}) END AS r
       FROM dbp a JOIN dbp b ON a.cluster <> b.cluster),
mx AS (SELECT i, max(r) AS r FROM pr GROUP BY i)
SELECT round(coalesce(avg(r), 0.0), 9) AS davies_bouldin FROM mx""")
def q_davies_bouldin(spark, sf_dir):
    return CU.davies_bouldin(labelled_fixed(spark, sf_dir), FEATS).select(
        F.round("davies_bouldin", 9).alias("davies_bouldin"))


@register("silhouette", "WITH " + SQL_ASSIGNED + ", lk AS (SELECT 0 AS k, * FROM lab), " + SQL_SILHOUETTE + """
SELECT round(silhouette, 9) AS silhouette_sq FROM sil""")
def q_silhouette(spark, sf_dir):
    return CU.silhouette_squared(labelled_fixed(spark, sf_dir), FEATS).select(
        F.round("silhouette_sq", 9).alias("silhouette_sq"))


SILHOUETTE_TOLERANCE = 1e-5


@register("silhouette_euclidean", "WITH " + SQL_ASSIGNED + f""",
sizes AS (SELECT cluster, count(*) AS n FROM lab GROUP BY cluster),
sums AS (SELECT a.customer_id, a.cluster AS own, b.cluster AS c, sum(sqrt({_dist_ab})) AS total
         FROM lab a, lab b GROUP BY ALL),
ab AS (SELECT customer_id, max(CASE WHEN own = c THEN n END) AS own_n,
              max(CASE WHEN own = c THEN total / nullif(n - 1, 0) END) AS a,
              min(CASE WHEN own <> c THEN total / n END) AS b
       FROM sums JOIN sizes ON c = cluster GROUP BY customer_id)
SELECT round(avg(CASE WHEN own_n = 1 OR greatest(a, b) <= 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 4) AS silhouette
FROM ab""")
def q_silhouette_euclidean(spark, sf_dir):
    return euclidean_silhouette(labelled_fixed(spark, sf_dir), FEATS, tolerance=SILHOUETTE_TOLERANCE) \
        .select(F.round("silhouette", 4).alias("silhouette"))


_SQL_MED = SQL_ASSIGNED + """,
med AS (SELECT cluster, median(recency) AS r, median(frequency) AS f, median(monetary) AS m
        FROM lab GROUP BY cluster)"""


@register("order_clusters", "WITH " + _SQL_MED + """,
mp AS (SELECT cluster, row_number() OVER (ORDER BY m ASC, cluster) - 1 AS new_id FROM med)
SELECT customer_id, CAST(new_id AS INTEGER) AS cluster FROM lab JOIN mp USING (cluster)""")
def q_order_clusters(spark, sf_dir):
    return CU.order_clusters(labelled_fixed(spark, sf_dir), mode="monetary").select("customer_id", "cluster")


@register("order_clusters_score", "WITH " + _SQL_MED + """,
sc AS (SELECT cluster, (row_number() OVER (ORDER BY r DESC, cluster) - 1)
                     + (row_number() OVER (ORDER BY f ASC, cluster) - 1)
                     + (row_number() OVER (ORDER BY m ASC, cluster) - 1) AS score FROM med),
mp AS (SELECT cluster, row_number() OVER (ORDER BY score, cluster) - 1 AS new_id FROM sc)
SELECT customer_id, CAST(new_id AS INTEGER) AS cluster FROM lab JOIN mp USING (cluster)""")
def q_order_clusters_score(spark, sf_dir):
    return CU.order_clusters(labelled_fixed(spark, sf_dir), mode="rfm_score").select("customer_id", "cluster")


# ---------------------------------------------------------------------------
# Classification: hash split, KNN (RFM with fixed labels; embeddings 64-d)
# ---------------------------------------------------------------------------
KNN_K_FIXED = 5


def _sql_split(id_expr: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({id_expr} AS VARCHAR) || ':512'), 1, 8)) AS BIGINT)"


@register("hash_split", f"""
SELECT c_custkey, {_sql_split('c_custkey')} AS split_key,
       {_sql_split('c_custkey')} % 1000 < 300 AS is_test,
       CAST(({_sql_split('c_custkey')} // 1000) % 4 AS INTEGER) AS fold
FROM customer""")
def q_hash_split(spark, sf_dir):
    c = T.read_table(spark, sf_dir, "customer").select("c_custkey")
    return CL.hash_split(c, "c_custkey")


@register("exact_split", f"""
WITH k AS (SELECT c_custkey, {_sql_split('c_custkey')} AS a, {_sql_split('c_custkey').replace(':512', ':513')} AS b FROM customer),
t AS (SELECT *, row_number() OVER (ORDER BY a, c_custkey) <= ceil(0.3 * (SELECT count(*) FROM k)) AS is_test FROM k),
r AS (SELECT *, CASE WHEN NOT is_test THEN row_number() OVER (PARTITION BY is_test ORDER BY b, c_custkey) - 1 END AS place,
             count(*) OVER (PARTITION BY is_test) AS n FROM t)
SELECT c_custkey, is_test,
       CAST(CASE WHEN place < (n % 4) * (n // 4 + 1) THEN place // (n // 4 + 1)
                 ELSE n % 4 + (place - (n % 4) * (n // 4 + 1)) // (n // 4) END AS INTEGER) AS fold
FROM r""")
def q_exact_split(spark, sf_dir):
    return exact_split(T.read_table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")


SQL_SPLIT_LAB = SQL_ASSIGNED + f""",
sl AS (SELECT lab.*, {_sql_split('customer_id')} AS sk FROM lab),
tr AS (SELECT *, CAST((sk // 1000) % 4 AS INTEGER) AS fold FROM sl WHERE sk % 1000 >= 300),
te AS (SELECT * FROM sl WHERE sk % 1000 < 300)"""


def _sql_vote(top: str, keys: str) -> str:
    """Distance-weighted vote over CTE ``top`` (cols keys..., nlab, d); returns winners."""
    return f"""
zz AS (SELECT {keys}, bool_or(d = 0) AS hz FROM {top} GROUP BY {keys}),
vv AS (SELECT {", ".join("t." + k.strip() for k in keys.split(","))}, t.nlab,
              sum(CASE WHEN zz.hz THEN (CASE WHEN t.d = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / t.d END) AS w
       FROM {top} t JOIN zz USING ({keys}) GROUP BY ALL),
win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY w DESC, nlab) AS r FROM vv)
        WHERE r = 1)"""


_sq_z = " + ".join(f"(te.z_{f} - tr.{f}) * (te.z_{f} - tr.{f})" for f in FEATS)


def rfm_split(spark, sf_dir):
    lab = CL.hash_split(labelled_fixed(spark, sf_dir), "customer_id")
    return lab.where(~F.col("is_test")), lab.where(F.col("is_test"))


@register("attach_customer_id", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer_number, sha256(c_name) AS customer_id
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q_attach_customer_id(spark, sf_dir):
    """Ids of the customer table on every invoice."""
    invoices = T.read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer_number"))
    customers = T.read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("customer_number"),
                                                               H.customer_hash("c_name").alias("customer_id"))
    return clean.attach_customer_id(invoices, customers).select("o_orderkey", "customer_number", "customer_id")


@register("labels_on_features", "WITH " + SQL_ASSIGNED + """
SELECT rfm.*, lab.cluster FROM rfm LEFT JOIN lab USING (customer_id)""")
def q_labels_on_features(spark, sf_dir):
    """Labels of the scaled rows back on the raw features."""
    return rfm_orders(spark, sf_dir).join(labelled_fixed(spark, sf_dir).select("customer_id", "cluster"), "customer_id", "left")


@register("knn_predict", "WITH " + SQL_SPLIT_LAB + f""",
nn AS (SELECT te.customer_id AS qid, tr.customer_id AS nid, tr.cluster AS nlab,
              {_sq_sql('te', 'tr', FEATS)} AS d2,
              row_number() OVER (PARTITION BY te.customer_id ORDER BY {_sq_sql('te', 'tr', FEATS)}, tr.customer_id) AS rn
       FROM te, tr),
top AS (SELECT qid, nlab, sqrt(d2) AS d FROM nn WHERE rn <= {KNN_K_FIXED}),""" + _sql_vote("top", "qid") + """
SELECT te.customer_id, te.cluster, CAST(win.nlab AS INTEGER) AS prediction
FROM te LEFT JOIN win ON te.customer_id = win.qid""")
def q_knn_predict(spark, sf_dir):
    train, test = rfm_split(spark, sf_dir)
    p = CL.knn_predict(test, train, FEATS, KNN_K_FIXED, "customer_id", "cluster")
    return p.select("customer_id", "cluster", "prediction")


@register("knn_join", "WITH " + SQL_SPLIT_LAB + f""",
nn AS (SELECT te.customer_id, tr.customer_id AS neighbour_id, tr.cluster AS label, {_sq_sql('te', 'tr', FEATS)} AS d2,
              row_number() OVER (PARTITION BY te.customer_id ORDER BY {_sq_sql('te', 'tr', FEATS)}, tr.customer_id) AS rn
       FROM te, tr)
SELECT customer_id, CAST(rn AS INTEGER) AS "rank", neighbour_id, CAST(label AS INTEGER) AS label,
       round(sqrt(d2), 9) AS distance
FROM nn WHERE rn <= {C.KNN_K_RANGE[-1]}""")
def q_knn_join(spark, sf_dir):
    train, test = rfm_split(spark, sf_dir)
    near = knn_join(test.select("customer_id", *FEATS), train, FEATS, C.KNN_K_RANGE[-1], "customer_id", "cluster")
    return near.select("customer_id", F.posexplode("neighbours").alias("at", "n")).select(
        "customer_id", (F.col("at") + 1).alias("rank"), F.col("n.id").alias("neighbour_id"), F.col("n.label").alias("label"),
        F.round("n.distance", 9).alias("distance"))


SQL_CV = SQL_SPLIT_LAB + f""",
nn AS (SELECT a.customer_id AS qid, b.customer_id AS nid, b.cluster AS nlab, {_sq_sql('a', 'b', FEATS)} AS d2,
              row_number() OVER (PARTITION BY a.customer_id ORDER BY {_sq_sql('a', 'b', FEATS)}, b.customer_id) AS rn
       FROM tr a JOIN tr b ON a.fold <> b.fold),
ks AS (SELECT unnest(range(1, 49, 2)) AS k),
top AS (SELECT ks.k, nn.qid, nn.nlab, sqrt(nn.d2) AS d FROM nn JOIN ks ON nn.rn <= ks.k),""" + \
    _sql_vote("top", "k, qid") + """,
acc AS (SELECT win.k, tr.fold, avg(CASE WHEN win.nlab = tr.cluster THEN 1.0 ELSE 0.0 END) AS a
        FROM win JOIN tr ON win.qid = tr.customer_id GROUP BY 1, 2),
cv AS (SELECT CAST(k AS INTEGER) AS k, round(avg(a), 9) AS accuracy FROM acc GROUP BY k)"""


def rfm_cv(spark, sf_dir):
    train, _ = rfm_split(spark, sf_dir)
    return CL.knn_cv_scores(train, FEATS, "customer_id", "cluster")


@register("score_rows", "WITH " + SQL_SPLIT_LAB + f""",
raw AS (SELECT customer_id, recency, frequency, monetary, {", ".join(
    f"(CAST({f} AS DOUBLE) - m_{f}) / s_{f} AS z_{f}" for f in FEATS)} FROM rfm, sp),
nn AS (SELECT te.customer_id AS qid, tr.cluster AS nlab, {_sq_z} AS d2,
              row_number() OVER (PARTITION BY te.customer_id ORDER BY {_sq_z}, tr.customer_id) AS rn
       FROM raw te, tr),
top AS (SELECT qid, nlab, sqrt(d2) AS d FROM nn WHERE rn <= {KNN_K_FIXED}),""" + _sql_vote("top", "qid") + """
SELECT raw.customer_id, raw.recency, raw.frequency, raw.monetary, CAST(win.nlab AS INTEGER) AS segment
FROM raw LEFT JOIN win ON raw.customer_id = win.qid""")
def q_score_rows(spark, sf_dir):
    """Raw features of every customer through the stored scaler and the labelled points."""
    raw = rfm_orders(spark, sf_dir)
    _, scaler = prepare.scale_data(raw, FEATS)
    train, _ = rfm_split(spark, sf_dir)
    points = train.select(F.col("customer_id").alias("id"), *FEATS, "cluster")
    return score(raw, KnnModel(scaler, points, FEATS, KNN_K_FIXED))


@register("knn_cv", "WITH " + SQL_CV + "\nSELECT * FROM cv")
def q_knn_cv(spark, sf_dir):
    return rfm_cv(spark, sf_dir).select(F.col("k").cast("int").alias("k"),
                                        F.round("accuracy", 9).alias("accuracy"))


@register("best_k", "WITH " + SQL_CV + """
SELECT k AS best_k, accuracy FROM cv ORDER BY accuracy DESC, k LIMIT 1""")
def q_best_k(spark, sf_dir):
    return CL.best_k(q_knn_cv(spark, sf_dir))


EMB_DIM = 64
_emb_d2 = " + ".join(f"(CAST(a.embedding[{i}] AS DOUBLE) - CAST(b.embedding[{i}] AS DOUBLE)) * "
                     f"(CAST(a.embedding[{i}] AS DOUBLE) - CAST(b.embedding[{i}] AS DOUBLE))"
                     for i in range(1, EMB_DIM + 1))
SQL_EMB_PRED = f"""
es AS (SELECT vec_id, embedding, label, {_sql_split('vec_id')} % 1000 < 300 AS is_test FROM embeddings),
tr AS (SELECT * FROM es WHERE NOT is_test),
te AS (SELECT * FROM es WHERE is_test),
nn AS (SELECT a.vec_id AS qid, b.label AS nlab, {_emb_d2} AS d2,
              row_number() OVER (PARTITION BY a.vec_id ORDER BY {_emb_d2}, b.vec_id) AS rn
       FROM te a, tr b),
top AS (SELECT qid, nlab, sqrt(d2) AS d FROM nn WHERE rn <= {KNN_K_FIXED}),""" + _sql_vote("top", "qid") + """,
pred AS (SELECT te.vec_id, te.label, CAST(win.nlab AS INTEGER) AS prediction
         FROM te LEFT JOIN win ON te.vec_id = win.qid)"""


def embeddings_predictions(spark, sf_dir):
    e = CL.hash_split(T.read_table(spark, sf_dir, "embeddings"), "vec_id")
    train, test = e.where(~F.col("is_test")), e.where(F.col("is_test"))
    return CL.knn_predict(test, train, "embedding", KNN_K_FIXED, "vec_id", "label")


@register("knn_embeddings", "WITH " + SQL_EMB_PRED + "\nSELECT * FROM pred")
def q_knn_embeddings(spark, sf_dir):
    return embeddings_predictions(spark, sf_dir).select("vec_id", "label", "prediction")


@register("confusion", "WITH " + SQL_EMB_PRED + """,
cls AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
grid AS (SELECT a.c AS label, b.c AS prediction FROM cls a, cls b WHERE a.c IS NOT NULL AND b.c IS NOT NULL),
cnt AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2),
fullg AS (SELECT g.label, g.prediction, coalesce(cnt.n, 0) AS n FROM grid g LEFT JOIN cnt USING (label, prediction)),
rs AS (SELECT label, sum(n) AS rsum FROM fullg GROUP BY label)
SELECT label, prediction, n, round(CASE WHEN rsum > 0 THEN n / rsum ELSE 0.0 END, 9) AS rate
FROM fullg JOIN rs USING (label)""")
def q_confusion(spark, sf_dir):
    cm = CL.confusion_matrix(embeddings_predictions(spark, sf_dir), "label", "prediction")
    return cm.select("label", "prediction", "n", F.round("rate", 9).alias("rate"))


@register("class_report", "WITH " + SQL_EMB_PRED + """,
cls AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
st AS (SELECT c,
         (SELECT count(*) FROM pred WHERE label = c AND prediction = c) AS tp,
         (SELECT count(*) FROM pred WHERE label = c) AS support,
         (SELECT count(*) FROM pred WHERE prediction = c) AS npred FROM cls),
pr AS (SELECT c, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM st),
per AS (SELECT CAST(c AS VARCHAR) AS class, precision, recall,
               CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
               support FROM pr),
alls AS (
  SELECT * FROM per
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM per
  UNION ALL SELECT 'accuracy', avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END),
                   avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END),
                   avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), count(*) FROM pred)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
       CAST(support AS BIGINT) AS support FROM alls""")
def q_class_report(spark, sf_dir):
    r = CL.classification_report(embeddings_predictions(spark, sf_dir), "label", "prediction")
    return r.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


# ---------------------------------------------------------------------------
# Distribution summaries of events.value
# ---------------------------------------------------------------------------
@register("box_stats", """
WITH q AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events WHERE value IS NOT NULL GROUP BY 1)
SELECT q.event_type, q.n, round(q1, 9) AS q1, round(median, 9) AS median, round(q3, 9) AS q3,
       round(q3 - q1, 9) AS iqr,
       min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END) AS whisker_lo,
       max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_hi,
       CAST(sum(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT)
         AS n_outliers
FROM events e JOIN q USING (event_type) WHERE value IS NOT NULL
GROUP BY q.event_type, q.n, q1, median, q3""")
def q_box_stats(spark, sf_dir):
    b = SU.box_stats(T.read_table(spark, sf_dir, "events"), "value", by="event_type")
    return b.select("event_type", "n", *[F.round(c, 9).alias(c) for c in ("q1", "median", "q3", "iqr")],
                    "whisker_lo", "whisker_hi", "n_outliers")


@register("histogram", """
WITH st AS (SELECT count(*) AS n, min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.25) AS q1,
                   quantile_cont(value, 0.75) AS q3 FROM events WHERE value IS NOT NULL),
bw AS (SELECT *, (hi - lo) / (log2(n) + 1.0) AS sturges, 2.0 * (q3 - q1) * pow(n, -1.0 / 3.0) AS fd FROM st),
nb AS (SELECT *, CAST(ceil((hi - lo) / (CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END)) AS INTEGER)
              AS bins FROM bw),
ed AS (SELECT bins, lo, hi, list_transform(range(bins + 1),
         lambda i: CASE WHEN i = bins THEN hi ELSE i * ((hi - lo) / bins) + lo END) AS e FROM nb),
ix AS (SELECT least(CAST(floor((value - lo) * (bins / (hi - lo))) AS INTEGER), bins - 1) AS i0, value, e, bins
       FROM events, ed WHERE value IS NOT NULL),
bi AS (SELECT CASE WHEN value < e[i0 + 1] THEN i0 - 1
                   WHEN value >= e[i0 + 2] AND i0 <> bins - 1 THEN i0 + 1 ELSE i0 END AS bin FROM ix),
cnt AS (SELECT bin, count(*) AS c FROM bi GROUP BY bin),
allb AS (SELECT unnest(range(bins)) AS bin, e FROM ed)
SELECT CAST(allb.bin AS INTEGER) AS bin, e[allb.bin + 1] AS lower, e[allb.bin + 2] AS upper,
       CAST(coalesce(c, 0) AS BIGINT) AS count
FROM allb LEFT JOIN cnt USING (bin)""")
def q_histogram(spark, sf_dir):
    return SU.histogram(T.read_table(spark, sf_dir, "events"), "value")


@register("density", """
WITH st AS (SELECT count(*) AS n, min(value) AS lo, max(value) AS hi, stddev_samp(value) AS sd
            FROM events WHERE value IS NOT NULL),
p AS (SELECT *, sd * pow(n, -0.2) AS h FROM st),
g AS (SELECT unnest(range(200)) AS i, n, lo, hi, h FROM p),
gx AS (SELECT i, CASE WHEN i = 199 THEN hi ELSE i * ((hi - lo) / 199) + lo END AS x, h, n FROM g)
SELECT CAST(i AS INTEGER) AS i, round(x, 9) AS x,
       round(sum(exp(-0.5 * ((x - value) / h) * ((x - value) / h))) * (1.0 / (n * h * sqrt(2 * pi()))), 9)
         AS density
FROM gx, events WHERE value IS NOT NULL GROUP BY i, x, h, n""")
def q_density(spark, sf_dir):
    d = SU.density(T.read_table(spark, sf_dir, "events"), "value")
    return d.select(F.col("i").cast("int").alias("i"), F.round("x", 9).alias("x"),
                    F.round("density", 9).alias("density"))


@register("fuzzy_ordered", "WITH RECURSIVE " + SQL_FUZZY_URL + """,
nd AS (SELECT page_id AS v, url FROM pages WHERE url IS NOT NULL),
ln AS (SELECT a.v AS s, b.v AS d FROM nd a JOIN nd b ON a.v < b.v
       WHERE a.url = b.url OR EXISTS (SELECT 1 FROM m WHERE m.key_a = least(a.url, b.url)
                                                        AND m.key_b = greatest(a.url, b.url))),
reach(s, d) AS (SELECT v, v FROM nd UNION SELECT r.s, ln.d FROM reach r JOIN ln ON r.d = ln.s),
own AS (SELECT d AS v, min(s) AS o FROM reach GROUP BY d),
lab AS (SELECT nd.v, coalesce(max(own.o), nd.v) AS l
        FROM nd LEFT JOIN ln ON ln.d = nd.v LEFT JOIN own ON own.v = ln.s GROUP BY nd.v)
SELECT pages.page_id, pages.url, g.url AS group_key, sha256(g.url) AS customer_id
FROM pages LEFT JOIN lab ON pages.page_id = lab.v LEFT JOIN nd g ON g.v = lab.l""")
def q_fuzzy_ordered(spark, sf_dir):
    pages = T.read_table(spark, sf_dir, "pages").select("page_id", "url")
    return resolve.resolve_ordered(pages, "page_id", "url", "page_id")


# ---------------------------------------------------------------------------
# Quartile tiers and segment names on RFM of orders
# ---------------------------------------------------------------------------
from ..operators import tiers as TI  # noqa: E402


def _sql_tier(f: str, better_high: bool) -> str:
    op = ">" if better_high else "<"
    return " + ".join(f"CAST({f} {op} tb_{f}[{i}] AS INTEGER)" for i in (1, 2, 3))


@register("rfm_segments", "WITH " + SQL_RFM + """,
tb AS (SELECT """ + ", ".join(
    f"quantile_cont(CAST({f} AS DOUBLE), [0.25, 0.5, 0.75]) AS tb_{f}" for f in FEATS) + """ FROM rfm),
tt AS (SELECT customer_id, recency, frequency, monetary, """ + ", ".join(
    f"{_sql_tier(f, TI.HIGHER_IS_BETTER[f])} AS {f}_tier" for f in FEATS) + """ FROM rfm, tb)
SELECT customer_id, recency_tier, frequency_tier, monetary_tier,
       recency_tier + frequency_tier + monetary_tier AS rfm_score,
       CASE WHEN recency_tier + frequency_tier + monetary_tier > 8 THEN 'top'
            WHEN recency_tier + frequency_tier + monetary_tier > 6 THEN 'high'
            WHEN recency_tier + frequency_tier + monetary_tier > 3 THEN 'medium'
            WHEN recency_tier + frequency_tier + monetary_tier > 0 THEN 'low' END AS segment
FROM tt""")
def q_rfm_segments(spark, sf_dir):
    t = TI.rfm_tiers(rfm_orders(spark, sf_dir))
    return t.select("customer_id", "recency_tier", "frequency_tier", "monetary_tier", "rfm_score", "segment")
