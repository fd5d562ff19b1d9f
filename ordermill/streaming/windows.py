"""The adaptive sliding windows over a stream of orders.

The window lengths come from a static table, as the volume of a state is not known in advance on
a stream.  A window is emitted once, when the watermark has passed its date.  Orders are folded into
daily totals first, and only these are fanned out over windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.functions.text import present
from ordermill.functions.values import is_positive, utc_date
from ordermill.operators.windows import LONG_DAYS, with_window_length
from ordermill.sources import star

DELAY = "1 day"


def read_orders(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The events table as a stream of orders: state, ordered_at, size, qty.

    ``files_per_batch`` bounds a micro-batch; files that differ in time must then come in its order.
    """
    schema = star.table(spark, folder, "events").schema
    # a file stream takes a folder or a pattern; this one finds the table as a file and as a folder
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return star.event_orders(stream.parquet(f"{folder}/events.parquet*"))


def window_totals(orders: DataFrame, lengths: DataFrame, long: int = LONG_DAYS, delay: str = DELAY) -> DataFrame:
    """Per (state, window_date, size): n, sum_qty, sum_qty_sq, as a streaming aggregate.

    Days are UTC days.  Orders are aggregated by (day, state, size); a day's totals go on once the
    watermark has passed it, meet the length of their state and count for that many windows.  Open
    days and open windows are all the state the stream keeps.  An order is late when the watermark
    has passed its day; it then counts for no window.
    """
    shipped = orders.filter(present(F.col("state")) & present(F.col("size")) & is_positive(F.col("qty")))
    daily = (
        shipped.withWatermark("ordered_at", delay)
        .groupBy(F.window("ordered_at", "1 day").alias("day"), "state", "size")
        .agg(F.count("*").alias("n"), F.sum("qty").alias("sum_qty"), F.sum(F.col("qty") * F.col("qty")).alias("sum_qty_sq"))
        .select(F.window_time("day").alias("day_time"), "state", "size", "n", "sum_qty", "sum_qty_sq")
    )
    reached = (
        with_window_length(daily, lengths, long)
        .withColumn("period", F.window("day_time", f"{long} days", "1 day"))
        .filter(F.datediff(utc_date(F.col("period.end")), utc_date(F.col("day_time"))) <= F.col("window_days"))
    )
    totals = reached.groupBy("period", "state", "size").agg(
        F.sum("n").alias("n"),
        F.sum("sum_qty").alias("sum_qty"),
        F.sum("sum_qty_sq").alias("sum_qty_sq"),
    )
    window_date = utc_date(F.col("period.end")).alias("window_date")
    return totals.select("state", window_date, "size", "n", "sum_qty", "sum_qty_sq")


def write_closed_windows(totals: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append closed windows to a Parquet folder; with ``available_now`` stop at the end of the input."""
    writer = totals.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
