"""Median number of product variants per style that reach a large size, by month and state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.text import present, size_rank
from ordermill.functions.values import month_of
from ordermill.schema import SIZES

MIN_RANK = 6  # XXL


def sku_max_rank(orders: DataFrame) -> DataFrame:
    """Largest size rank of each sku per (month, state, style); unknown sizes do not count."""
    complete = present(F.col("state")) & present(F.col("style")) & present(F.col("sku"))
    return (
        orders.filter(complete & F.col("order_date").isNotNull() & F.col("size").isin(SIZES))
        .select(
            month_of(F.col("order_date")).alias("month"),
            "state",
            "style",
            "sku",
            size_rank(F.col("size")).alias("rank"),
        )
        .groupBy("month", "state", "style", "sku")
        .agg(F.max("rank").alias("max_rank"))
    )


def style_variety(skus: DataFrame, min_rank: int = MIN_RANK) -> DataFrame:
    """Number of skus per (month, state, style), for styles that reach ``min_rank``."""
    return (
        skus.groupBy("month", "state", "style")
        .agg(F.count("*").alias("variety"), F.max("max_rank").alias("max_rank"))
        .filter(F.col("max_rank") >= min_rank)
    )


def median_variety(styles: DataFrame) -> DataFrame:
    """Exact median of the variety per (month, state).

    The aggregate keeps a count per distinct variety and merges those counts, so the number of
    styles in a group does not matter.
    """
    return styles.groupBy("month", "state").agg(F.median("variety").alias("median_variety"))
