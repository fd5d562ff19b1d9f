"""The sliding windows over orders that arrive in loads: each load is read once, and only the windows
that it reaches are rebuilt.

Below one folder lie three tables and a note:

* ``daily``: the daily totals of every load, partitioned by load and month.  A load is put in its place whole,
  so to add it again changes nothing, and to add it corrected replaces it.
* ``windows``: the window totals, partitioned by the month of the window date.
* ``lengths``: the window length of each state that the windows were built with.
* ``pending``: the days whose windows are still to be rebuilt.  It is written before the totals change and
  deleted when the windows are built, so a run that dies in between is made good by the next.

A month holds no more than days x states x sizes totals, so its partition is one small file.  Orders are
never kept.  One writer at a time: loads are numbered and added one after the other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.values import month_of
from ordermill.operators import windows
from ordermill.session import hadoop_path, stage
from ordermill.sources.writers import replace_folder, restore, restore_inside, write_parquet

DAILY = "load long, month date, order_date date, state string, size string, n_volume long, n long, sum_qty double, sum_qty_sq double"
WINDOWS = "month date, window_date date, state string, size string, n long, sum_qty double, sum_qty_sq double"
LENGTHS = "state string, window_days int"
PENDING = "day date"
TOTALS = ["sum_qty", "sum_qty_sq"]


def _table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    path = f"{root}/{name}"
    restore(spark, path)
    files, place = hadoop_path(spark, path)
    return spark.read.schema(schema).parquet(path) if files.exists(place) else spark.createDataFrame([], schema)


def _by_month(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("month", month_of(F.col(date))).repartition("month")


def _in_sum_type(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in TOTALS})


def daily_totals(spark: SparkSession, root: str) -> DataFrame:
    """What `windows.daily_totals` gives for the orders of all loads."""
    return _summed(_table(spark, root, "daily", DAILY))


def _summed(daily: DataFrame) -> DataFrame:
    return daily.groupBy("state", "order_date", "size").agg(*_sums())


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("n_volume", "n", *TOTALS)]


def add_load(orders: DataFrame, root: str, load: int) -> None:
    """Fold the orders of a load into daily totals, in the place of what the load held before.

    ``orders`` is a frame of `orders.window_orders`.  Days that the load held before or holds now are noted
    as pending; `refresh` rebuilds their windows.
    """
    spark = orders.sparkSession
    path = f"{root}/daily/load={load}"
    restore(spark, path)
    if load <= _folded_up_to(spark, root):
        raise ValueError(f"load {load} has been folded")
    fresh = stage(_in_sum_type(windows.daily_totals(orders)), "load")
    before = _table(spark, root, "daily", DAILY).where(F.col("load") == load).select("order_date")
    _note(spark, root, before.union(fresh.select("order_date")))
    dealt = _by_month(fresh, "order_date")
    replace_folder(spark, path, lambda folder: dealt.write.partitionBy("month").parquet(folder))


def _note(spark: SparkSession, root: str, days: DataFrame) -> None:
    # the new note holds the old one, which is read before its folder is replaced
    all_days = _table(spark, root, "pending", PENDING).union(days).where("day is not null").distinct()
    write_parquet(all_days.coalesce(1), f"{root}/pending")


def _reached(daily: DataFrame, days: DataFrame, lengths: DataFrame, known: DataFrame, longest: int, default: int) -> list[dt.date]:
    """Months with windows that may have changed: those after a pending day, and all of a state whose
    window length is another than the one its windows were built with.

    The driver gets calendar months, whose number the span of the orders bounds.
    """
    both = lengths.join(known.withColumnRenamed("window_days", "before"), "state", "full")
    length = lambda name: F.coalesce(name, F.lit(default))  # noqa: E731 - of a state without volume
    changed = both.where(length("window_days") != length("before")).select("state")
    moved = daily.join(changed, "state", "left_semi").select(F.col("order_date").alias("day"))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(longest)))
    each = days.union(moved).where("day is not null").distinct().select("day", ahead.alias("ahead"))
    return sorted(r.month for r in each.select(month_of(F.date_add("day", F.col("ahead"))).alias("month")).distinct().collect())


def _months_behind(months: list[dt.date], days: int) -> list[dt.date]:
    """The given months and those that their windows look back on."""
    found = set()
    for month in months:
        back = (month - dt.timedelta(days=days)).replace(day=1)
        while back <= month:
            found.add(back)
            back = (back + dt.timedelta(days=31)).replace(day=1)
    return sorted(found)


def refresh(
    spark: SparkSession,
    root: str,
    cutoff: float | None = windows.VOLUME_CUTOFF,
    short: int = windows.SHORT_DAYS,
    long: int = windows.LONG_DAYS,
) -> list[dt.date]:
    """Rebuild the windows that the pending days reach, and return their months; the options stay the same for
    a folder.

    Only the daily totals that these windows look back on are read again, by month; of all others the
    volumes alone are read.  A state whose volume passes the cut-off changes its window length,
    and then all its windows are rebuilt.  Without a cut-off, the average volume is taken.
    """
    longest, path = max(short, long), f"{root}/windows"
    restore_inside(spark, f"{root}/daily")
    raw = _table(spark, root, "daily", DAILY)
    volume = stage(windows.volume_of(raw), "volume")
    lengths = windows.window_lengths(volume, windows.mean_volume(volume) if cutoff is None else cutoff, short, long)
    lengths = stage(lengths, "lengths")
    pending, known = _table(spark, root, "pending", PENDING), _table(spark, root, "lengths", LENGTHS)
    months = _reached(raw, pending, lengths, known, longest, long)
    if months:
        needed = F.col("month").isin(_months_behind(months, longest))
        totals = windows.window_totals(_summed(raw.where(needed)), lengths, long)
        fresh = stage(_by_month(totals, "window_date").where(F.col("month").isin(months)), "windows")
        writer = fresh.repartition("month").write.partitionBy("month")
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        filled = {r.month for r in fresh.select("month").distinct().collect()}
        for gone in set(months) - filled:  # the overwrite leaves partitions alone that nothing is written to
            files, place = hadoop_path(spark, f"{path}/month={gone}")
            files.delete(place, True)
    write_parquet(lengths, f"{root}/lengths")
    files, place = hadoop_path(spark, f"{root}/pending")
    files.delete(place, True)
    return months


def window_totals(spark: SparkSession, root: str) -> DataFrame:
    """state, window_date, size, n, sum_qty, sum_qty_sq of every window, open ones included."""
    return _table(spark, root, "windows", WINDOWS).select("state", "window_date", "size", "n", *TOTALS)


def popular_sizes(spark: SparkSession, root: str) -> DataFrame:
    """state, window_date, size: what `reports.popular_sizes` gives for the orders of all loads."""
    return windows.top_size(window_totals(spark, root))


def fold_loads(spark: SparkSession, root: str, up_to: int) -> None:
    """Sum the loads up to a number into one, so that a long run of small loads stays few files.

    A folded load cannot be added again.  The table of daily totals is written afresh and replaced whole.
    """
    load = F.greatest("load", F.lit(up_to)).alias("load")
    folded = _table(spark, root, "daily", DAILY).groupBy(load, "month", "order_date", "state", "size").agg(*_sums())
    note = folded.sparkSession.createDataFrame([(max(up_to, _folded_up_to(spark, root)),)], "load long")
    write_parquet(note.coalesce(1), f"{root}/folded")
    dealt = folded.repartition("load", "month")
    write_parquet(dealt, f"{root}/daily", partition_by=["load", "month"])


def _folded_up_to(spark: SparkSession, root: str) -> int:
    found = _table(spark, root, "folded", "load long").first()
    return -1 if found is None else found.load
