"""State names: spelling, alias lookup, city corrections, missing and unmapped values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.text import trim_unicode
from ordermill.schema import CITY_FIXES, MISSING_MARKERS, STATE_ALIASES, STATES


def known_states(spark: SparkSession) -> DataFrame:
    """alias -> canon for the order table: every canonical name and every known alias."""
    rows = [(name, name) for name in STATES] + list(STATE_ALIASES.items())
    return spark.createDataFrame(rows, "alias string, canon string")


def blank_missing(df: DataFrame, column: str, markers: Iterable[str] = MISSING_MARKERS) -> DataFrame:
    """Null in place of the texts that stand for a missing value."""
    col = F.col(column)
    return df.withColumn(column, F.when(~col.isin(list(markers)), col))


def standard_spelling(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.upper(trim_unicode(F.col(column))))


def replace_aliases(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Replace the values listed in ``aliases`` (unique on ``alias``), keep all others."""
    lookup = aliases.select(F.col("alias").alias(column), F.col("canon").alias("_canon"))
    joined = df.join(lookup, column, "left")
    return joined.select(*[F.coalesce("_canon", c).alias(c) if c == column else c for c in df.columns])


def fix_by_city(
    df: DataFrame,
    state: str = "ship-state",
    city: str = "ship-city",
    fixes: Iterable[tuple[str, str, str]] = CITY_FIXES,
) -> DataFrame:
    """Correct the state of rows with a given (state, city); the city is compared as written."""
    value = F.col(state)
    for code, place, name in fixes:
        value = F.when((F.col(state) == code) & (F.col(city) == place), name).otherwise(value)
    return df.withColumn(state, value)


def distinct_states(df: DataFrame, state: str) -> DataFrame:
    """The sorted state names (the result has one row per name)."""
    return df.select(state).distinct().orderBy(state)


def unmapped_states(df: DataFrame, state: str, aliases: DataFrame) -> DataFrame:
    """State names that are no target of the alias table, with their number of rows."""
    names = df.groupBy(state).agg(F.count("*").alias("n_rows"))
    targets = aliases.select(F.col("canon").alias(state)).distinct()
    return names.join(targets, state, "left_anti").orderBy(state)


def cleaning_summary(spelled: DataFrame, state: str) -> DataFrame:
    """Rows before and after the drop of missing states, rows removed, states left."""
    col = F.col(state)
    return spelled.agg(
        F.count("*").alias("rows_in"),
        F.count(col).alias("rows_out"),
        F.count_if(col.isNull()).alias("rows_removed"),
        F.countDistinct(col).alias("n_states"),
    )
