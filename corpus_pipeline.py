"""The corpus pipeline: documents through the stages of ``STAGES``, each written and read again.

A stage starts when the result of the one before has been written, so it first deletes the scratch
tables that one has left in the shared folder. Tables of other queries of the session stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from custseg.llm import catalog, exact, minhash, mixing, packing, toxicity
from custseg.session import materialise, release_scratch, scratch_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
SCRATCH = "pipeline"


def stage(function: Stage) -> Stage:
    """``function`` with its scratch tables in the pipeline's scope, after those of the stage before are
    deleted."""
    @wraps(function)
    def scoped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_scratch(spark, SCRATCH)
        with scratch_scope(SCRATCH):
            return function(spark, docs, sf_dir)
    return scoped


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.keep_civil(docs, toxicity.fit(docs, labels))


@stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact.drop_duplicates(docs)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.drop_near_duplicates(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out so that the sources meet their target weights."""
    return mixing.mixed_documents(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens, with their token ids."""
    return packing.pack(docs, catalog.tokenizer_path(), keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The stages learn, hash and draw; SQL cannot express them. tests/llm/test_pipeline.py checks
#: every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the ``documents`` of ``sf_dir``; every result but the last is written
    to the shared folder and read again, and deleted when the next one is written. Null ids and texts,
    repeated rows and empty tables pass as each operator states."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, function in STAGES[:-1]:
        result = function(spark, docs, sf_dir)
        with scratch_scope(f"{SCRATCH} {name}"):
            docs = materialise(result, name.replace(" ", "_"))
        if before:
            release_scratch(spark, f"{SCRATCH} {before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
