"""The corpus pipeline: language, lines, near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` applies them in order to the
documents, writing each result as Parquet below spark.checkpoint.dir and reading it again.  All
stages but the last return the columns of the documents they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import decontaminate, language, line_dedup, packing, simhash
from ordermill.llm.common import stage, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the corpus; null, letterless and unlike texts go."""
    return language.keep_languages(docs)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut; n_chars, if there, follows the text."""
    cut = line_dedup.dedup_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.keep_one(docs, shingle=3, most=3)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as sequences with bucket, batch and row."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("lines", cut_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("packing", pack),
]

# Kernel regression and fingerprints are beyond SQL; tests/llm checks the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
