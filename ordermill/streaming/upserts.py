"""The adaptive sliding windows over a stream, kept up to date batch by batch: open windows are there, and a
late order counts however late it comes.

The stream itself keeps no state.  Every micro-batch is a load of `plans.loads`, numbered by its batch: its
daily totals take the place of what the batch wrote before, so a batch that runs again after a failure
changes nothing.  Window lengths follow the volume as it grows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.functions.values import utc_date
from ordermill.operators import windows
from ordermill.plans import loads
from ordermill.session import staging


def as_window_orders(orders: DataFrame) -> DataFrame:
    """Shipped orders with a moment (state, ordered_at, size, qty) in the shape of `orders.window_orders`."""
    return orders.select(
        "state",
        utc_date(F.col("ordered_at")).alias("order_date"),
        F.lit("Shipped").alias("status"),
        "size",
        "qty",
        F.col("qty").cast("int").alias("whole_qty"),
    )


def put_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    cutoff: float | None = windows.VOLUME_CUTOFF,
    short: int = windows.SHORT_DAYS,
    long: int = windows.LONG_DAYS,
) -> None:
    """Add a micro-batch as load ``batch_id`` and rebuild the windows that it reaches."""
    with staging(batch.sparkSession):
        loads.add_load(batch, root, batch_id)
        loads.refresh(batch.sparkSession, root, cutoff, short, long)


def start(
    orders: DataFrame, put: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Call ``put`` with each micro-batch and its number; with ``available_now`` stop at the end of the input."""
    writer = orders.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_window_updates(
    orders: DataFrame, root: str, checkpoint: str, available_now: bool = False, **options
) -> StreamingQuery:
    """Keep the windows below ``root`` up to date with a stream of `as_window_orders`; options as `put_batch`."""
    return start(orders, lambda batch, batch_id: put_batch(batch, batch_id, root, **options), checkpoint, available_now)
