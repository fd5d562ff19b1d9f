"""The registered queries of the pipeline operators, as (spark, folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (
    decontaminate,
    embeddings,
    language,
    licenses,
    line_dedup,
    packing,
    pii,
    quality,
    quality_rules,
    resample,
    sharding,
    simhash,
    spelling,
)
from ordermill.llm.common import table


def op1_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"), shards=16)


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


# How a line of a document that serves as a licence file begins.
NOTICE = r"(?im)^(this work is licensed under|licensed under|released under)\b"


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: source/lang/hundreds of the id/id.txt.

    A document that holds a notice is LICENSE-id.txt, by its id in the folder of the source, the
    language or the hundreds, so that folders at three depths pass licences on.
    """
    docs = table(spark, folder, "documents")
    name, parts = F.col("doc_id").cast("string"), ["source", "lang", F.floor(F.col("doc_id") / 100).cast("string")]
    plain = F.concat_ws("/", *parts, F.concat(name, F.lit(".txt")))
    file = F.concat(F.lit("LICENSE-"), name, F.lit(".txt"))
    depth = F.pmod("doc_id", F.lit(3))
    licence = F.when(depth == 0, F.concat_ws("/", *parts[:1], file)).when(depth == 1, F.concat_ws("/", *parts[:2], file))
    path = F.when(F.col("text").rlike(NOTICE), licence.otherwise(F.concat_ws("/", *parts, file))).otherwise(plain)
    return licenses.scan_licenses(docs.select("doc_id", path.alias("path"), "text"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    marked = decontaminate.mark_contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return marked.drop("hit_spans")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_pii(table(spark, folder, "documents"))


def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents")).drop("_text", "_root")


def op10_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op11_resample(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(table(spark, folder, "documents"), damage_every=199)


def op13_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, folder, "documents")).drop("failed")


QUERIES = {
    f.__name__: f
    for f in (
        op1_shards,
        op2_language,
        op3_licenses,
        op4_quality,
        op5_decontaminate,
        op6_packing,
        op7_pii,
        op8_embeddings,
        op9_simhash,
        op10_lines,
        op11_resample,
        op12_spelling,
        op13_rules,
    )
}
