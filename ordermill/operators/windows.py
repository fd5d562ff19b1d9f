"""Adaptive sliding day windows and the most popular size in each.

An order of day d counts for the window dates d+1 ... d+w of its state, so window date D looks
back on the w days before it.  w is short for a state with a large shipped volume.

The order table is read once, into one row per (state, day, size).  Everything after that works
on those totals: a state that holds a third of all orders has no more of these rows than any
other busy state, so neither the fan-out over window dates nor the windows below are skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.text import present
from ordermill.functions.values import is_positive

VOLUME_CUTOFF = 10_000
SHORT_DAYS = 5
LONG_DAYS = 10
VARIANCE_TOLERANCE = 1e-9


def _shipped() -> Column:
    # a substring test, so "Unshipped" passes as well
    return F.lower("status").contains("shipped") & present(F.col("state"))


def _in_volume() -> Column:
    return F.coalesce(F.col("whole_qty") > 0, F.lit(False))


def _in_window() -> Column:
    return F.coalesce(is_positive(F.col("qty")), F.lit(False)) & present(F.col("size")) & F.col("order_date").isNotNull()


def shipped_orders(orders: DataFrame) -> DataFrame:
    """The orders that count for windows: shipped, positive quantity, with state, size and date."""
    return orders.filter(_shipped() & _in_window()).select("state", "order_date", "size", "qty")


def daily_totals(orders: DataFrame) -> DataFrame:
    """Per (state, order_date, size): n, sum_qty, sum_qty_sq and the share n_volume of the volume.

    Volume and windows have different conditions.  Orders that count for the volume only (no
    size or date) land in the row of their state whose date and size are null, with n = 0.
    """
    volume, window = _in_volume(), _in_window()
    return (
        orders.filter(_shipped() & (volume | window))
        .select(
            "state",
            F.when(window, F.col("order_date")).alias("order_date"),
            F.when(window, F.col("size")).alias("size"),
            volume.alias("volume"),
            F.when(window, F.col("qty")).alias("qty"),
        )
        .groupBy("state", "order_date", "size")
        .agg(
            F.count_if("volume").alias("n_volume"),
            F.count("qty").alias("n"),
            F.sum("qty").alias("sum_qty"),
            F.sum(F.col("qty") * F.col("qty")).alias("sum_qty_sq"),
        )
    )


def shipped_state_volume(orders: DataFrame) -> DataFrame:
    """Number of shipped orders per state."""
    return orders.filter(_shipped() & _in_volume()).groupBy("state").agg(F.count("*").alias("n_orders"))


def volume_of(daily: DataFrame) -> DataFrame:
    """The shipped volume per state, from daily totals."""
    return daily.groupBy("state").agg(F.sum("n_volume").alias("n_orders")).filter("n_orders > 0")


def mean_volume(volume: DataFrame) -> float:
    """The average shipped volume of the states, a cut-off that follows the data."""
    return volume.agg(F.avg("n_orders")).first()[0] or 0.0


def window_lengths(
    volume: DataFrame, cutoff: float = VOLUME_CUTOFF, short: int = SHORT_DAYS, long: int = LONG_DAYS
) -> DataFrame:
    """Window length per state: ``short`` above the cut-off, else ``long``."""
    if min(short, long) < 1:
        raise ValueError("a window has at least one day")
    length = F.when(F.col("n_orders") > cutoff, short).otherwise(long)
    return volume.select("state", length.alias("window_days"))


def with_window_length(df: DataFrame, lengths: DataFrame, default: int = LONG_DAYS) -> DataFrame:
    """Add ``window_days`` by state; a state without volume gets the default."""
    return df.join(lengths, "state", "left").withColumn("window_days", F.coalesce("window_days", F.lit(default)))


def window_totals(daily: DataFrame, lengths: DataFrame, default: int = LONG_DAYS) -> DataFrame:
    """Per (state, window_date, size): n, sum_qty, sum_qty_sq over the window's days."""
    sized = with_window_length(daily.filter("n > 0").drop("n_volume"), lengths, default)
    return (
        sized.withColumn("ahead", F.explode(F.sequence(F.lit(1), "window_days")))
        .groupBy("state", F.date_add("order_date", F.col("ahead")).alias("window_date"), "size")
        .agg(
            F.sum("n").alias("n"),
            F.sum("sum_qty").alias("sum_qty"),
            F.sum("sum_qty_sq").alias("sum_qty_sq"),
        )
    )


def with_variance(totals: DataFrame) -> DataFrame:
    """Add the population variance of the quantity, from the three totals."""
    mean = F.col("sum_qty") / F.col("n")
    return totals.withColumn("variance", F.col("sum_qty_sq") / F.col("n") - mean * mean)


def top_size(totals: DataFrame, tolerance: float = VARIANCE_TOLERANCE) -> DataFrame:
    """One size per (state, window_date): most orders, then least variance, then first by name.

    Variances closer than ``tolerance`` to the least one count as equal.  A variance that is no
    number (infinite quantities) loses against any that is one; if there is none, the name decides.
    The window frame holds one row per size, and the aggregate reuses its partitioning.
    """
    group = Window.partitionBy("state", "window_date")
    steadiness = F.when(F.isnan("variance"), F.lit(float("-inf"))).otherwise(-F.col("variance"))
    best = F.max(F.struct(F.col("n"), F.col("steadiness"))).over(group)
    steady = (F.col("best.steadiness") - F.col("steadiness") < tolerance) | (
        F.col("best.steadiness") == F.lit(float("-inf"))
    )
    return (
        with_variance(totals)
        .withColumn("steadiness", steadiness)
        .withColumn("best", best)
        .filter((F.col("n") == F.col("best.n")) & steady)
        .groupBy("state", "window_date")
        .agg(F.min("size").alias("size"))
    )
