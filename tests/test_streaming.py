import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from ordermill.operators import windows
from ordermill.streaming import windows as streaming

SCHEMA = "state string, ordered_at timestamp, size string, qty int"


def moment(day, hour=12):
    return dt.datetime(2022, 4, day, hour, tzinfo=dt.timezone.utc)


def run(spark, source, lengths, out, checkpoint):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    totals = streaming.window_totals(stream, lengths, long=4)
    streaming.write_closed_windows(totals, out, checkpoint, available_now=True).awaitTermination()
    return spark.read.schema(totals.schema).parquet(out)


def test_closed_windows_equal_the_batch_result_and_resume(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    lengths = spark.createDataFrame([("KA", 2)], "state string, window_days int")
    first = [("KA", moment(1), "M", 1), ("KA", moment(2, 0), "S", 2), ("GOA", moment(3, 23), "M", 3), ("KA", moment(3), "M", 0)]
    second = [("KA", moment(8), "L", 1), ("KA", moment(1), "XS", 5), ("GOA", moment(9, 1), "S", 2)]

    spark.createDataFrame(first, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    early = run(spark, source, lengths, out, checkpoint)
    # the watermark is at April 2, 23:00, so only the window that ends on April 2 is closed
    assert rows(early, "state", "window_date", "size", "n") == [("KA", dt.date(2022, 4, 2), "M", 1)]

    spark.createDataFrame(second, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    result = run(spark, source, lengths, out, checkpoint)

    orders = spark.createDataFrame(first + second, SCHEMA).select(
        "state",
        F.to_date("ordered_at").alias("order_date"),
        "size",
        F.lit("Shipped").alias("status"),
        "qty",
        F.col("qty").alias("whole_qty"),
    )
    batch = windows.window_totals(windows.daily_totals(orders), lengths, 4)
    # the watermark had passed April 1 when its late order came
    closed = batch.filter(F.col("window_date") <= dt.date(2022, 4, 8)).filter("size <> 'XS'")
    columns = ["state", "window_date", "size", "n", "sum_qty", "sum_qty_sq"]
    assert rows(result, *columns) == rows(closed, *columns)
