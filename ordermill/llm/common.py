"""Helpers that several operators share: text as words, row identity, gapless numbers, merged spans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.session import stage

__all__ = ["ascii_lower", "let", "merged_spans", "numbered", "stage", "table", "text_id", "two_hashes", "unused"]

SALTS = 1024  # fixed: numbers must not depend on a setting of the session
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII takes the fast path of `lower`, with the same result."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, even where `use` refers to it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unused(name: str, df: DataFrame) -> str:
    """`name`, with underscores before it until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_id(text: Column) -> Column:
    """Tells apart the texts of one id; with the id it names a row up to repeated rows."""
    return F.xxhash64(text)


def two_hashes(*columns: Column) -> Column:
    """96 bits of hash, as a struct: wide enough for the windows of a very large corpus."""
    return F.struct(F.xxhash64(*columns).alias("h1"), F.hash(*columns).alias("h2"))


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """`df` with a gapless number from 0 within `group` (columns without nulls).

    A group of any size is dealt out over SALTS buckets by the hash of `order`; rows are
    numbered inside their bucket and shifted by the size of the buckets before.  So a number depends
    on the data alone, up to rows that tie in `order`: these may take each other's.  `df` is read
    twice, so callers stage it.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        salted.groupBy(*group, "_salt")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*group, "_salt", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*group, "_salt").orderBy(*order)
    return (
        salted.withColumn("_nth", F.row_number().over(inside) - 1)
        .join(offsets, [*group, "_salt"])
        .withColumn(name, (F.col("_nth") + F.col("_before")).cast("long"))
        .drop("_salt", "_nth", "_before")
    )


def merged_spans(spans: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Half-open spans of each key merged where they overlap or touch: keys, start, end."""
    ordered = Window.partitionBy(*keys).orderBy(start, end)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col(start) > F.max(end).over(earlier), F.lit(True)).cast("long")
    return (
        spans.select(*keys, start, end)
        .withColumn("_opens", opens)
        .withColumn("_island", F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("_island")
    )
