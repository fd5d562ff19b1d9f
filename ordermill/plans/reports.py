"""The complete analyses, each from an input frame to its result frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ordermill.functions.values import month_text
from ordermill.operators import cleaning, percentiles, promos, variety, windows
from ordermill.schema import CITY_FIXES, DATE_PATTERN
from ordermill.session import stage, stage_all


def spell_states(
    df: DataFrame,
    aliases: DataFrame | None = None,
    state: str = "ship-state",
    city: str = "ship-city",
    fixes: Sequence[tuple[str, str, str]] = CITY_FIXES,
) -> DataFrame:
    """All rows with the state in its canonical spelling; missing states stay null."""
    if aliases is None:
        aliases = cleaning.known_states(df.sparkSession)
    spelled = cleaning.standard_spelling(cleaning.blank_missing(df, state), state)
    return cleaning.fix_by_city(cleaning.replace_aliases(spelled, state, aliases), state, city, fixes)


def clean_states(
    df: DataFrame,
    aliases: DataFrame | None = None,
    state: str = "ship-state",
    city: str = "ship-city",
    fixes: Sequence[tuple[str, str, str]] = CITY_FIXES,
) -> DataFrame:
    """`spell_states` without the rows whose state is missing."""
    return spell_states(df, aliases, state, city, fixes).dropna(subset=[state])


def clean_states_counted(
    df: DataFrame,
    aliases: DataFrame | None = None,
    state: str = "ship-state",
    city: str = "ship-city",
    fixes: Sequence[tuple[str, str, str]] = CITY_FIXES,
) -> tuple[DataFrame, Observation]:
    """`clean_states` and its counts rows_in, rows_out and rows_removed, taken on the way.

    The observation has them once the frame has been written or collected; no scan is made for them.
    """
    spelled = spell_states(df, aliases, state, city, fixes)
    counts = Observation("clean states")
    seen = spelled.observe(
        counts,
        F.count(F.lit(1)).alias("rows_in"),
        F.count(state).alias("rows_out"),
        F.count_if(F.col(state).isNull()).alias("rows_removed"),
    )
    return seen.dropna(subset=[state]), counts


def popular_sizes(
    orders: DataFrame,
    cutoff: float | None = windows.VOLUME_CUTOFF,
    short: int = windows.SHORT_DAYS,
    long: int = windows.LONG_DAYS,
) -> DataFrame:
    """state, window_date, size: the most popular size of every adaptive window.

    The daily totals are staged, as both the volumes and the windows come from them.  Without a
    cut-off, states above the average volume get the short window.
    """
    daily = stage(windows.daily_totals(orders), "daily")
    volume = windows.volume_of(daily)
    lengths = windows.window_lengths(volume, windows.mean_volume(volume) if cutoff is None else cutoff, short, long)
    return windows.top_size(windows.window_totals(daily, lengths, long))


def dates_as_text(sizes: DataFrame) -> DataFrame:
    """Rows in the order of state and date, with the date in the pattern of the order table."""
    text = F.date_format("window_date", DATE_PATTERN)
    return sizes.orderBy("state", "window_date").select("state", text.alias("window_date"), "size")


def median_varieties(orders: DataFrame, min_rank: int = variety.MIN_RANK) -> DataFrame:
    """month, state, median_variety."""
    medians = variety.median_variety(variety.style_variety(variety.sku_max_rank(orders), min_rank))
    return medians.withColumn("month", month_text(F.col("month")))


def qualified_orders(
    orders: DataFrame, min_days: int = promos.MIN_ACTIVE_DAYS, min_valid: int = promos.MIN_VALID_CODES
) -> DataFrame:
    """The cancelled standard orders with n_valid, state_avg and qualified.

    ``orders`` are read once, into a staged copy of the columns that count.  The code lifespans and state
    averages are staged too: the planner then joins by their real sizes.
    """
    orders = stage(orders.select(*promos.COLUMNS), "orders")
    lifespans, thresholds = stage_all(
        lifespans=promos.promo_lifespan(orders), thresholds=promos.state_threshold(orders)
    )
    counted = promos.with_valid_count(promos.cancelled_candidates(orders), lifespans, min_days)
    return promos.with_qualified(counted, thresholds, min_valid)


def cancelled_share(
    orders: DataFrame, min_days: int = promos.MIN_ACTIVE_DAYS, min_valid: int = promos.MIN_VALID_CODES
) -> DataFrame:
    """city, total_orders, qualified_orders, pct_cancelled, in the order of the city."""
    return promos.city_share(qualified_orders(orders, min_days, min_valid))


def promo_percentiles(
    prepared: DataFrame,
    probabilities: Sequence[float] = percentiles.PROBABILITIES,
    accuracy: int = percentiles.SKETCH_ACCURACY,
) -> DataFrame:
    """Approximate and exact thresholds and deviations per (sku, month), with their differences,
    in the order of sku and month.

    ``prepared`` is read once.  The result is staged before it is ordered, as a total order runs its
    input twice, once to find the ranges.
    """
    compared = stage(percentiles.compared_percentiles(prepared, probabilities, accuracy), "percentiles")
    return compared.orderBy(*percentiles.GROUP).withColumn("month", month_text(F.col("month")))
