"""Promotion codes by active period, and the cancelled orders that meet promotion and price rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.text import code_list, code_name, present
from ordermill.functions.values import percentage

# the columns of `orders.promo_orders` that the operators below read
COLUMNS = [
    "row_id", "order_date", "status", "fulfilment", "courier_status", "service_level", "city", "state", "amount", "promotion_ids",
]
MIN_ACTIVE_DAYS = 2
MIN_VALID_CODES = 3


def promo_lifespan(orders: DataFrame) -> DataFrame:
    """First and last day, days between and number of uses (n_tokens) of every promotion code."""
    return (
        orders.filter(F.col("order_date").isNotNull() & F.col("promotion_ids").isNotNull())
        .select("order_date", F.explode(code_list(F.col("promotion_ids"))).alias("entry"))
        .select("order_date", code_name(F.col("entry")).alias("promo"))
        .filter(F.col("promo").isNotNull())
        .groupBy("promo")
        .agg(
            F.min("order_date").alias("first_d"),
            F.max("order_date").alias("last_d"),
            F.count("*").alias("n_tokens"),
        )
        .withColumn("active_days", F.datediff("last_d", "first_d"))
    )


def valid_promos(lifespans: DataFrame, min_days: int = MIN_ACTIVE_DAYS) -> DataFrame:
    return lifespans.filter(F.col("active_days") >= min_days)


def _in_threshold() -> Column:
    return (
        (F.col("fulfilment") == "Merchant") & (F.col("courier_status") == "Shipped") & present(F.col("state"))
    )


def _is_candidate() -> Column:
    return F.lower("status").contains("cancelled") & (F.col("service_level") == "Standard")


def state_threshold(orders: DataFrame) -> DataFrame:
    """Average amount per state of the merchant-fulfilled orders shipped by the courier."""
    return orders.filter(_in_threshold()).groupBy("state").agg(F.avg("amount").alias("state_avg"))


def cancelled_candidates(orders: DataFrame) -> DataFrame:
    """Cancelled orders of the standard service level."""
    return orders.filter(_is_candidate()).select("row_id", "city", "state", "amount", "promotion_ids")


def valid_uses(candidates: DataFrame, lifespans: DataFrame, min_days: int = MIN_ACTIVE_DAYS) -> DataFrame:
    """row_id, n_valid: the uses of valid codes per order id; a repeated code counts each time.

    Uses are looked up by a plain join on the code.  The planner broadcasts the valid codes if their
    staged size allows; else adaptive execution splits the uses of a frequent code over tasks.
    """
    uses = (
        candidates.filter(F.col("row_id").isNotNull())
        .select("row_id", F.explode(code_list(F.col("promotion_ids"))).alias("entry"))
        .select("row_id", code_name(F.col("entry")).alias("promo"))
        .filter(F.col("promo").isNotNull())
    )
    valid = valid_promos(lifespans, min_days).select("promo")
    return uses.join(valid, "promo").groupBy("row_id").agg(F.count("*").alias("n_valid"))


def with_valid_count(candidates: DataFrame, lifespans: DataFrame, min_days: int = MIN_ACTIVE_DAYS) -> DataFrame:
    """Add n_valid, the number of valid codes under the id of each order.

    ``lifespans`` is a staged `promo_lifespan`.  Rows that share an id share the count.  Orders
    without ``row_id`` have none; they pass by the join, whatever their number.
    """
    kept = candidates.select("row_id", "city", "state", "amount", "promotion_ids")
    known = kept.filter(F.col("row_id").isNotNull()).drop("promotion_ids")
    counted = known.join(valid_uses(candidates, lifespans, min_days), "row_id", "left")
    counted = counted.withColumn("n_valid", F.coalesce("n_valid", F.lit(0).cast("long")))
    unknown = kept.filter(F.col("row_id").isNull()).drop("promotion_ids")
    return counted.unionByName(unknown.withColumn("n_valid", F.lit(0).cast("long")))


def with_qualified(counted: DataFrame, thresholds: DataFrame, min_valid: int = MIN_VALID_CODES) -> DataFrame:
    """Add state_avg and the 0/1 flag qualified: enough valid codes and an amount below the average.

    ``thresholds`` is a staged `state_threshold`.  A missing amount or average does not qualify.
    """
    meets = (F.col("n_valid") >= min_valid) & (F.col("amount") < F.col("state_avg"))
    joined = counted.join(thresholds, "state", "left")
    return joined.withColumn("qualified", F.when(meets, 1).otherwise(0))


def city_share(orders: DataFrame) -> DataFrame:
    """Orders, qualified orders and their percentage per city."""
    counts = (
        orders.filter(present(F.col("city")))
        .groupBy("city")
        .agg(F.count("*").alias("total_orders"), F.sum("qualified").alias("qualified_orders"))
    )
    share = percentage(F.col("qualified_orders"), F.col("total_orders"))
    return counts.withColumn("pct_cancelled", share).orderBy("city")


def city_totals(cities: DataFrame) -> DataFrame:
    """Cities, orders, qualified orders and the largest qualified number, in one row."""
    return cities.agg(
        F.count("*").alias("cities"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("qualified_orders").alias("qualified_orders"),
        F.max("qualified_orders").alias("max_qualified"),
    )
