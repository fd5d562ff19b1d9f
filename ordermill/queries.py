"""The registered queries: every operator on the star-schema tables, as (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.text import promo_count
from ordermill.functions.values import month_text
from ordermill.operators import cleaning, percentiles, promos, variety, windows
from ordermill.plans import loads, reports
from ordermill.session import new_folder, stage
from ordermill.sources import orders, readers, star, writers
from ordermill.streaming import upserts
from ordermill.streaming import windows as streaming

Query = Callable[[SparkSession, str], DataFrame]

# City corrections in terms of the star schema.
CITY_FIXES = [("N21", "BUILDING", "NATION_21"), ("N22", "MACHINERY", "NATION_22")]


def _dates_as_strings(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.date_format(name, "yyyy-MM-dd") for name in names})


def _months_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("month", month_text(F.col("month")))


def _rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in names})


def _rounded_average(df: DataFrame) -> DataFrame:
    # averages of cents often end in a 5 in the third to fifth place, which summation rounds either way
    return _rounded(df, 6, "state_avg")


# --- sources ---------------------------------------------------------------------------------


def _from_csv(spark: SparkSession, folder: str, read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    path = new_folder(spark, "csv")
    writers.write_csv(star.raw_sales_order(spark, folder), path)
    typed = orders.promo_orders(read(spark, path))
    n_promos = promo_count(F.col("promotion_ids")).alias("n_promos")
    columns = ["row_id", "order_date", "city", "state", "amount", "promotion_ids", n_promos]
    return _dates_as_strings(typed.select(*columns), "order_date")


def orders_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    return _from_csv(spark, folder, readers.read_csv)


def orders_from_records(spark: SparkSession, folder: str) -> DataFrame:
    """The same orders, with line ends inside their lists of codes, by several tasks per file."""
    return _from_csv(spark, folder, readers.read_records)


def orders_from_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "lines")
    star.order_lines(spark, folder).write.text(path)
    return _dates_as_strings(orders.window_orders(readers.read_lines(spark, path)), "order_date")


def line_fates(spark: SparkSession, folder: str) -> DataFrame:
    """How many CSV lines became orders, and how many were left out for which reason."""
    path = new_folder(spark, "lines")
    star.order_lines(spark, folder).write.text(path)
    kept, left_out = readers.land_lines(spark, path, new_folder(spark, "landed"))
    fates = kept.select(F.lit("kept").alias("fate")).unionByName(left_out.select(F.col("reason").alias("fate")))
    return fates.groupBy("fate").agg(F.count("*").alias("n_lines"))


# --- state names -----------------------------------------------------------------------------


def _spelled(spark: SparkSession, folder: str) -> DataFrame:
    customers = star.dirty_state(spark, folder).withColumnRenamed("state_raw", "state")
    return reports.spell_states(customers, star.state_alias(spark, folder), "state", "city", CITY_FIXES)


def state_fix_by_city(spark: SparkSession, folder: str) -> DataFrame:
    return _spelled(spark, folder).select("row_id", "city", "state")


def clean_states(spark: SparkSession, folder: str) -> DataFrame:
    customers = star.dirty_state(spark, folder).withColumnRenamed("state_raw", "state")
    aliases = star.state_alias(spark, folder)
    return reports.clean_states(customers, aliases, "state", "city", CITY_FIXES).select("row_id", "city", "state")


def distinct_states(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.distinct_states(clean_states(spark, folder), "state")


def unmapped_states(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.unmapped_states(clean_states(spark, folder), "state", star.state_alias(spark, folder))


def clean_summary(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cleaning_summary(_spelled(spark, folder), "state")


def clean_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in, out and removed, as the cleaning reports them while it writes."""
    customers = star.dirty_state(spark, folder).withColumnRenamed("state_raw", "state")
    cleaned, counts = reports.clean_states_counted(customers, star.state_alias(spark, folder), "state", "city", CITY_FIXES)
    cleaned.write.parquet(new_folder(spark, "clean"))
    return spark.createDataFrame([counts.get], "rows_in long, rows_out long, rows_removed long")


# --- sliding windows -------------------------------------------------------------------------


def shipped_state_volume(spark: SparkSession, folder: str) -> DataFrame:
    return windows.shipped_state_volume(star.sales_line(spark, folder))


def state_window_length(spark: SparkSession, folder: str) -> DataFrame:
    volume = stage(shipped_state_volume(spark, folder), "volume")
    return windows.window_lengths(volume, windows.mean_volume(volume))


def window_input(spark: SparkSession, folder: str) -> DataFrame:
    return _dates_as_strings(windows.shipped_orders(star.sales_line(spark, folder)), "order_date")


def _window_totals(spark: SparkSession, folder: str) -> DataFrame:
    daily = stage(windows.daily_totals(star.sales_line(spark, folder)), "daily")
    volume = windows.volume_of(daily)
    return windows.window_totals(daily, windows.window_lengths(volume, windows.mean_volume(volume)))


def window_triplets(spark: SparkSession, folder: str) -> DataFrame:
    return _dates_as_strings(_window_totals(spark, folder), "window_date")


def window_size_variance(spark: SparkSession, folder: str) -> DataFrame:
    totals = windows.with_variance(_window_totals(spark, folder)).drop("sum_qty", "sum_qty_sq")
    return _dates_as_strings(_rounded(totals, 6, "variance"), "window_date")


def window_top_size(spark: SparkSession, folder: str) -> DataFrame:
    return _dates_as_strings(reports.popular_sizes(star.sales_line(spark, folder), cutoff=None), "window_date")


def window_two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """The same sizes from two loads: the second brings the later half and, late, a tenth of the first."""
    lines, root = star.sales_line(spark, folder), new_folder(spark, "loads")
    late = F.pmod(F.xxhash64("sku", "order_date"), F.lit(10)) == 0
    second = (F.col("order_date") >= "1998-06-01") | late
    for number, load in enumerate([lines.where(~second), lines.where(second)]):
        loads.add_load(load, root, number)
        loads.refresh(spark, root, cutoff=None)
    return _dates_as_strings(loads.popular_sizes(spark, root), "window_date")


# --- style variety ---------------------------------------------------------------------------


def sku_max_rank(spark: SparkSession, folder: str) -> DataFrame:
    return _months_as_text(variety.sku_max_rank(star.sales_line(spark, folder)))


def style_variety(spark: SparkSession, folder: str) -> DataFrame:
    return _months_as_text(variety.style_variety(variety.sku_max_rank(star.sales_line(spark, folder))))


def median_variety(spark: SparkSession, folder: str) -> DataFrame:
    return reports.median_varieties(star.sales_line(spark, folder))


# --- promotions ------------------------------------------------------------------------------


def _promo_orders(spark: SparkSession, folder: str) -> DataFrame:
    return orders.normalize_places(star.sales_order(spark, folder))


def normalized_orders(spark: SparkSession, folder: str) -> DataFrame:
    typed = _promo_orders(spark, folder).select("row_id", "order_date", "city", "state", "amount")
    return _dates_as_strings(typed, "order_date")


def promo_lifespan(spark: SparkSession, folder: str) -> DataFrame:
    return _dates_as_strings(promos.promo_lifespan(_promo_orders(spark, folder)), "first_d", "last_d")


def valid_promos(spark: SparkSession, folder: str) -> DataFrame:
    return promos.valid_promos(promos.promo_lifespan(_promo_orders(spark, folder))).select("promo")


def state_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_average(promos.state_threshold(_promo_orders(spark, folder)))


def cancelled_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return promos.cancelled_candidates(_promo_orders(spark, folder))


def valid_promo_count(spark: SparkSession, folder: str) -> DataFrame:
    frame = stage(_promo_orders(spark, folder).select(*promos.COLUMNS), "orders")
    lifespans = stage(promos.promo_lifespan(frame), "lifespans")
    counted = promos.with_valid_count(promos.cancelled_candidates(frame), lifespans)
    return counted.filter("n_valid > 0").select("row_id", "n_valid")


def qualified_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_average(reports.qualified_orders(_promo_orders(spark, folder)))


def city_cancel_pct(spark: SparkSession, folder: str) -> DataFrame:
    return reports.cancelled_share(_promo_orders(spark, folder))


def city_totals(spark: SparkSession, folder: str) -> DataFrame:
    return promos.city_totals(city_cancel_pct(spark, folder))


def promo_count_per_order(spark: SparkSession, folder: str) -> DataFrame:
    frame = star.sales_order(spark, folder)
    return frame.select("row_id", promo_count(F.col("promotion_ids")).alias("n_promos"))


# --- percentiles -----------------------------------------------------------------------------


def _prepared(spark: SparkSession, folder: str) -> DataFrame:
    return orders.sku_months(star.brand_line(spark, folder))


def prepared_sku_month(spark: SparkSession, folder: str) -> DataFrame:
    return _months_as_text(_prepared(spark, folder))


def pct_approx(spark: SparkSession, folder: str) -> DataFrame:
    return _months_as_text(percentiles.approx_thresholds(_prepared(spark, folder)))


def pct_exact(spark: SparkSession, folder: str) -> DataFrame:
    exact = percentiles.exact_percentiles(_prepared(spark, folder))
    return _months_as_text(exact.select("sku", "month", "p90_thresh_exact", "p80_thresh_exact"))


def pct_sketch_year(spark: SparkSession, folder: str) -> DataFrame:
    """Approximate percentiles per sku and year, merged from the stored sketches of its months."""
    sketches = stage(percentiles.promo_sketches(_prepared(spark, folder)), "sketches")
    year = F.year("month").alias("year")
    return percentiles.sketched_thresholds(sketches, ["sku", year])


def pct_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Nearest-rank percentiles of the price in cents per sku and year: nearly as many values as orders."""
    prices = _prepared(spark, folder).select(
        "sku", F.trunc("month", "year").alias("month"), F.round(F.col("amount") * 100).cast("long").alias("n_promos"), "amount"
    )
    wide = percentiles.wide_percentiles(prices)
    return _rounded(_months_as_text(wide), 4, "p90_stddev_exact", "p80_stddev_exact")


def stddev_above_approx(spark: SparkSession, folder: str) -> DataFrame:
    approx = percentiles.approx_percentiles(_prepared(spark, folder))
    return _rounded(_months_as_text(approx), 4, "p90_stddev_approx", "p80_stddev_approx")


def stddev_above_exact(spark: SparkSession, folder: str) -> DataFrame:
    exact = percentiles.exact_percentiles(_prepared(spark, folder))
    return _rounded(_months_as_text(exact), 4, "p90_stddev_exact", "p80_stddev_exact")


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    return percentiles.compared_percentiles(_prepared(spark, folder))


def pct_compare(spark: SparkSession, folder: str) -> DataFrame:
    compared = reports.promo_percentiles(_prepared(spark, folder))
    return _rounded(compared, 4, *[c for c in compared.columns if "stddev" in c])


def pct_diff_report(spark: SparkSession, folder: str) -> DataFrame:
    return percentiles.difference_report(_compared(spark, folder))


def pct_max_diff(spark: SparkSession, folder: str) -> DataFrame:
    largest = percentiles.largest_differences(_compared(spark, folder))
    return _rounded(largest, 4, *[c for c in largest.columns if "stddev" in c])


def _levels(spark: SparkSession, folder: str) -> DataFrame:
    return percentiles.compared_levels(_prepared(spark, folder), (0.5, 0.2))


def pct_diff_levels(spark: SparkSession, folder: str) -> DataFrame:
    """The difference report where thresholds do differ: the median against the P90, P20 against P80."""
    return percentiles.difference_report(_levels(spark, folder))


def pct_max_diff_levels(spark: SparkSession, folder: str) -> DataFrame:
    largest = percentiles.largest_differences(_levels(spark, folder))
    return _rounded(largest, 4, *[c for c in largest.columns if "stddev" in c])


def pct_preview(spark: SparkSession, folder: str) -> DataFrame:
    first = _months_as_text(percentiles.preview(_levels(spark, folder), 20))
    return _rounded(first, 4, *[c for c in first.columns if "stddev" in c])


def stddev_nonzero(spark: SparkSession, folder: str) -> DataFrame:
    exact = percentiles.exact_percentiles(_prepared(spark, folder))
    groups = _months_as_text(percentiles.nonzero_deviation(exact))
    return _rounded(groups.select("sku", "month", "p90_stddev_exact"), 4, "p90_stddev_exact")


def stddev_profile(spark: SparkSession, folder: str) -> DataFrame:
    return percentiles.deviation_profile(percentiles.exact_percentiles(_prepared(spark, folder)))


# --- streaming -------------------------------------------------------------------------------


def stream_sliding_window(spark: SparkSession, folder: str) -> DataFrame:
    """The events arrive in two halves, in the order of time; the stream stops and resumes in between."""
    events = star.table(spark, folder, "events")
    volume = stage(star.event_orders(events).groupBy("state").agg(F.count("*").alias("n_orders")), "volume")
    lengths = stage(windows.window_lengths(volume, windows.mean_volume(volume)), "lengths")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = (x or 0 for x in events.agg(F.min(micros), F.max(micros)).first())
    half = F.coalesce((micros - F.lit(first) > F.lit((last - first) / 2)).cast("int"), F.lit(0))
    source, path, checkpoint = (new_folder(spark, name) for name in ("events", "closed-windows", "stream"))
    landing = new_folder(spark, "landing")
    events.withColumn("half", half).write.partitionBy("half").parquet(landing)
    for n in range(2):
        writers.move_folder(spark, f"{landing}/half={n}", f"{source}/events.parquet{'-later' * n}")
        totals = streaming.window_totals(streaming.read_orders(spark, source), lengths)
        streaming.write_closed_windows(totals, path, checkpoint, available_now=True).awaitTermination()
    return _dates_as_strings(spark.read.schema(totals.schema).parquet(path), "window_date")


def stream_open_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Open windows too: the events arrive in two batches of any times, and the second arrives twice."""
    root, source = new_folder(spark, "live-windows"), new_folder(spark, "events")
    star.table(spark, folder, "events").repartition(2, "event_id").write.parquet(f"{source}/events.parquet")
    stream = upserts.as_window_orders(streaming.read_orders(spark, source, files_per_batch=1))

    def put(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2 if batch_id else 1):
            upserts.put_batch(batch, batch_id, root, cutoff=None)

    upserts.start(stream, put, new_folder(spark, "stream"), available_now=True).awaitTermination()
    return _dates_as_strings(loads.window_totals(spark, root), "window_date")


QUERIES: dict[str, Query] = {
    "orders_from_csv": orders_from_csv,
    "orders_from_records": orders_from_records,
    "orders_from_lines": orders_from_lines,
    "line_fates": line_fates,
    "clean_states": clean_states,
    "state_fix_by_city": state_fix_by_city,
    "unmapped_states": unmapped_states,
    "distinct_states": distinct_states,
    "clean_summary": clean_summary,
    "clean_counts": clean_counts,
    "shipped_state_volume": shipped_state_volume,
    "state_window_length": state_window_length,
    "window_input": window_input,
    "window_triplets": window_triplets,
    "window_size_variance": window_size_variance,
    "window_top_size": window_top_size,
    "window_two_loads": window_two_loads,
    "sku_max_rank": sku_max_rank,
    "style_variety": style_variety,
    "median_variety": median_variety,
    "normalized_orders": normalized_orders,
    "promo_lifespan": promo_lifespan,
    "valid_promos": valid_promos,
    "state_threshold": state_threshold,
    "cancelled_candidates": cancelled_candidates,
    "valid_promo_count": valid_promo_count,
    "qualified_orders": qualified_orders,
    "city_cancel_pct": city_cancel_pct,
    "city_totals": city_totals,
    "promo_count": promo_count_per_order,
    "prepared_sku_month": prepared_sku_month,
    "pct_approx": pct_approx,
    "pct_exact": pct_exact,
    "pct_sketch_year": pct_sketch_year,
    "pct_wide": pct_wide,
    "stddev_above_approx": stddev_above_approx,
    "stddev_above_exact": stddev_above_exact,
    "pct_compare": pct_compare,
    "pct_diff_report": pct_diff_report,
    "pct_max_diff": pct_max_diff,
    "pct_diff_levels": pct_diff_levels,
    "pct_max_diff_levels": pct_max_diff_levels,
    "pct_preview": pct_preview,
    "stddev_nonzero": stddev_nonzero,
    "stddev_profile": stddev_profile,
    "stream_sliding_window": stream_sliding_window,
    "stream_open_windows": stream_open_windows,
}
