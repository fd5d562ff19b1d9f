"""Typed order frames, one narrow projection of the raw order table per family of operators.

The raw table has string columns under its own header names; the results below have fresh
lower-case names, so nothing depends on case-insensitive column replacement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.text import present, promo_count, trim_control
from ordermill.functions.values import month_of, number_or_zero, parse_date, parse_date_clamped


def window_orders(raw: DataFrame) -> DataFrame:
    """state, order_date, status, size, qty, whole_qty: the input of the sliding windows.

    ``whole_qty`` is 0 where the quantity is not written as a whole number; the volume of a
    state goes by it, the windows go by ``qty``.
    """
    return raw.select(
        F.upper(trim_control(F.col("ship-state"))).alias("state"),
        parse_date_clamped(trim_control(F.col("Date"))).alias("order_date"),
        trim_control(F.col("Status")).alias("status"),
        trim_control(F.col("Size")).alias("size"),
        number_or_zero(F.col("Qty"), "double").alias("qty"),
        number_or_zero(F.col("Qty"), "int").alias("whole_qty"),
    )


def variety_orders(raw: DataFrame) -> DataFrame:
    """state, order_date, style, sku, size: the input of the style variety.  Case is kept."""
    return raw.select(
        trim_control(F.col("ship-state")).alias("state"),
        parse_date_clamped(trim_control(F.col("Date"))).alias("order_date"),
        trim_control(F.col("Style")).alias("style"),
        trim_control(F.col("SKU")).alias("sku"),
        trim_control(F.col("Size")).alias("size"),
    )


def promo_orders(raw: DataFrame) -> DataFrame:
    """The input of the promotion operators, with city and state in one spelling."""
    return normalize_places(
        raw.select(
            F.col("index").try_cast("long").alias("row_id"),
            parse_date(F.col("Date")).alias("order_date"),
            F.col("Status").alias("status"),
            F.col("Fulfilment").alias("fulfilment"),
            F.col("Courier Status").alias("courier_status"),
            F.col("ship-service-level").alias("service_level"),
            F.col("ship-city").alias("city"),
            F.col("ship-state").alias("state"),
            F.col("Amount").try_cast("double").alias("amount"),
            F.col("promotion-ids").alias("promotion_ids"),
        )
    )


def normalize_places(orders: DataFrame) -> DataFrame:
    """City and state trimmed and in upper case."""
    return orders.withColumns({name: F.upper(F.trim(F.col(name))) for name in ("city", "state")})


def sku_orders(raw: DataFrame) -> DataFrame:
    """sku, month (its first day), n_promos, amount: the input of the percentile operators."""
    return sku_months(
        raw.select(
            F.col("SKU").alias("sku"),
            parse_date(F.col("Date")).alias("order_date"),
            promo_count(F.col("promotion-ids")).alias("n_promos"),
            F.col("Amount").try_cast("double").alias("amount"),
        )
    )


def sku_months(orders: DataFrame) -> DataFrame:
    """Normalise the sku, derive the month and keep the orders that have both."""
    sku = F.upper(F.trim(F.col("sku")))
    return orders.filter(present(sku) & F.col("order_date").isNotNull()).select(
        sku.alias("sku"), month_of(F.col("order_date")).alias("month"), "n_promos", "amount"
    )
