"""The registered queries of the llm operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from custseg.llm import (ann, exact, external_shuffle, filter_audit, html_text, minhash, mixing, packing, periodic,
                         quality, secret_scan, suffix, toxicity)
from custseg.sources.tables import read_table


def tokenizer_path() -> str:
    """The vocabulary file of the packing contract; a parameter of ``packing.pack``."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_pack_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.mix(read_table(spark, sf_dir, "documents")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_duplicates(read_table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM t
"""


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents")).drop("uid", "text_hash", "first")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.decide(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(read_table(spark, sf_dir, "documents")).drop("spans")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return secret_scan.digest(secret_scan.scan(docs, secret_scan.train(docs)))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"), html_text.train())


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.grade(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.find_runs(periodic.plant_runs(read_table(spark, sf_dir, "documents"))))


def op12_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return external_shuffle.digest(external_shuffle.shuffled(read_table(spark, sf_dir, "documents")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_audit.marked(read_table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.cells(rows, read_table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH t AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words FROM documents),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
    SELECT t.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
           + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
           + 8 * regexp_matches(text, '[#$%&*|]')::INT
           + 16 * coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)::INT AS mask
    FROM t LEFT JOIN known USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
    SELECT filter_order, step, bit,
           (SELECT coalesce(sum(p.bit), 0) FROM letters p WHERE instr(substr(filter_order, 1, step - 1), p.letter) > 0) AS pre
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s JOIN letters ON letter = substr(filter_order, step, 1)),
counted AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN mask & (pre | bit)::INT = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & pre::INT = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & pre::INT <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & pre::INT = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & pre::INT = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pack_mixture": op1_pack_mixture,
        "op2_mix_sources": op2_mix_sources,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_main_text": op4_main_text,
        "op5_minhash_near_dedup": op5_minhash_near_dedup,
        "op6_quality": op6_quality,
        "op7_nearest_neighbours": op7_nearest_neighbours,
        "op8_secret_scan": op8_secret_scan,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_toxicity": op10_toxicity,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_external_shuffle": op12_external_shuffle,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": OP3_SQL, "op13_filter_audit": OP13_SQL}
