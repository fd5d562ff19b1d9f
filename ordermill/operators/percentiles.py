"""Percentile thresholds of the promotion count per (sku, month), and the spread of amounts above.

Orders are first folded into one bin per (sku, month, n_promos) that holds their number and the
count, mean and squared deviations of their amounts.  Exact percentiles and the standard
deviation above any threshold follow from the bins, so no task ever sees the orders of a group:
a sku with a third of all orders has as many bins as it has distinct promotion counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.session import stage

PROBABILITIES = (0.90, 0.80)
ACCURACY = 10_000
# of the sketches that travel with the bins: their memory, and most of their time, is in proportion to it
SKETCH_ACCURACY = 2_000
TOLERANCE = 0.0001

GROUP = ["sku", "month"]


def cut_names(method: str, probabilities: Sequence[float] = PROBABILITIES) -> list[str]:
    """Names of the threshold columns of a method: p90_thresh_exact, p80_thresh_exact."""
    return [f"p{round(p * 100)}_thresh_{method}" for p in probabilities]


def deviation_name(cut: str) -> str:
    """Name of the deviation above a threshold: p90_thresh_exact -> p90_stddev_exact."""
    return cut.replace("_thresh_", "_stddev_")


def sketch_size(accuracy: int) -> int:
    """The k of a KLL sketch whose ranks are off by no more than 1 / accuracy (at 99 % confidence).

    Fixed values: the published error of the sketch is 2.296 / k ** 0.9723, and k lies in 8 ... 65535.
    """
    return min(max(math.ceil((2.296 * accuracy) ** (1 / 0.9723)), 8), 65_535)


def promo_bins(prepared: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Per (sku, month, n_promos): n, n_amounts, mean_amount, and the squared deviations sq_dev.

    With an accuracy the bins carry a mergeable quantile sketch of their counts, so that bins and
    approximate percentiles come from one scan.
    """
    sketch = [] if accuracy is None else [_sketch(F.col("n_promos"), accuracy).alias("sketch")]
    return (
        prepared.groupBy(*GROUP, "n_promos")
        .agg(
            F.count("*").alias("n"),
            F.count("amount").alias("n_amounts"),
            F.avg("amount").alias("mean_amount"),
            F.var_pop("amount").alias("var_amount"),
            *sketch,
        )
        .withColumn("sq_dev", F.col("var_amount") * F.col("n_amounts"))
        .drop("var_amount")
    )


def approx_thresholds(
    prepared: DataFrame, probabilities: Sequence[float] = PROBABILITIES, accuracy: int = ACCURACY
) -> DataFrame:
    """Approximate percentiles of n_promos and the number of orders per (sku, month)."""
    sketch = F.percentile_approx("n_promos", list(probabilities), accuracy)
    cuts = [F.col("cuts")[i].alias(name) for i, name in enumerate(cut_names("approx", probabilities))]
    return (
        prepared.groupBy(*GROUP)
        .agg(sketch.alias("cuts"), F.count("*").alias("total_group_orders"))
        .select(*GROUP, *cuts, "total_group_orders")
    )


def _sketch(value: Column, accuracy: int) -> Column:
    return F.kll_sketch_agg_bigint(value, F.lit(sketch_size(accuracy)))


def _merged(sketch: str, accuracy: int) -> Column:
    return F.kll_merge_agg_bigint(F.col(sketch), F.lit(sketch_size(accuracy)))


def _quantiles(sketch: Column, probabilities: Sequence[float]) -> list[Column]:
    """The smallest values whose rank reaches each probability; counts of codes are whole numbers."""
    found = F.kll_sketch_get_quantile_bigint(sketch, F.array(*[F.lit(float(p)) for p in probabilities]))
    return [found[i].cast("int") for i in range(len(probabilities))]


def promo_sketches(prepared: DataFrame, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """A quantile sketch of n_promos and the number of orders per (sku, month), a column to be stored.

    Stored sketches of further orders of the same groups are merged like those of further groups.
    """
    return prepared.groupBy(*GROUP).agg(
        _sketch(F.col("n_promos"), accuracy).alias("sketch"), F.count("*").alias("n_orders")
    )


def sketched_thresholds(
    sketches: DataFrame, keys: Sequence[Column | str], probabilities: Sequence[float] = PROBABILITIES, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Approximate percentiles per ``keys`` of stored sketches, merged: the orders are not read again."""
    merged = sketches.groupBy(*keys).agg(
        _merged("sketch", accuracy).alias("_merged"), F.sum("n_orders").alias("total_group_orders")
    )
    cuts = zip(_quantiles(F.col("_merged"), probabilities), cut_names("approx", probabilities))
    return merged.select("*", *[cut.alias(name) for cut, name in cuts]).drop("_merged")


def with_sketched_thresholds(
    bins: DataFrame, probabilities: Sequence[float] = PROBABILITIES, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Add the approximate percentiles of the bins' merged sketches, by the windows that the exact ones use."""
    merged = bins.withColumn("_merged", _merged("sketch", accuracy).over(Window.partitionBy(*GROUP)))
    cuts = dict(zip(cut_names("approx", probabilities), _quantiles(F.col("_merged"), probabilities)))
    return merged.withColumns(cuts).drop("_merged", "sketch")


def rank_errors(bins: DataFrame, thresholds: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Per (sku, month), how far the approximate thresholds lie from their probabilities: the part of the
    orders between the rank of the threshold and the rank that was asked for, 0.0 if it holds that rank."""
    names = cut_names("approx", probabilities)
    joined = bins.select(*GROUP, "n_promos", "n").join(thresholds.select(*GROUP, *names), GROUP)
    parts = [F.sum("n").alias("orders")]
    for i, name in enumerate(names):
        parts.append(F.sum(F.when(F.col("n_promos") < F.col(name), F.col("n"))).alias(f"below{i}"))
        parts.append(F.sum(F.when(F.col("n_promos") <= F.col(name), F.col("n"))).alias(f"upto{i}"))
    counted = joined.groupBy(*GROUP).agg(*parts)
    errors = []
    for i, (name, p) in enumerate(zip(names, probabilities)):
        wanted = F.ceil(F.col("orders") * F.lit(float(p)))
        low, high = F.coalesce(f"below{i}", F.lit(0)) + 1, F.coalesce(f"upto{i}", F.lit(0))
        error = F.greatest(low - wanted, wanted - high, F.lit(0)) / F.col("orders")
        errors.append(error.alias(name.replace("_thresh_approx", "_rank_error")))
    return counted.select(*GROUP, "orders", *errors)


def with_exact_thresholds(bins: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Add the nearest-rank percentiles of n_promos: the value at rank ceil(p * n) of its group."""
    group = Window.partitionBy(*GROUP)
    upto = group.orderBy("n_promos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = bins.withColumns({"rank": F.sum("n").over(upto), "orders": F.sum("n").over(group)})
    cuts = {}
    for name, p in zip(cut_names("exact", probabilities), probabilities):
        reached = F.col("rank") >= F.ceil(F.col("orders") * F.lit(float(p)))
        cuts[name] = F.min(F.when(reached, F.col("n_promos"))).over(group)
    return ranked.withColumns(cuts).drop("rank", "orders")


def wide_thresholds(bins: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """`with_exact_thresholds` for groups with very many distinct values, as one row per (sku, month).

    No task sees the values of a group in order.  The bins are dealt by ranges of (sku, month, n_promos) and
    staged; the totals of the ranges are few, and their running sums tell which range holds a wanted
    rank.  Only inside these ranges are values counted one by one.
    """
    dealt = bins.select(*GROUP, "n_promos", "n").repartitionByRange(*GROUP, "n_promos")
    ranges = stage(dealt.withColumn("range", F.spark_partition_id()), "ranges")
    group = Window.partitionBy(*GROUP)
    before = F.coalesce(F.sum("total").over(group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = ranges.groupBy(*GROUP, "range").agg(F.sum("n").alias("total"))
    totals = totals.withColumns({"before": before, "orders": F.sum("total").over(group)})
    names = cut_names("exact", probabilities)
    wanted = [
        F.struct(F.lit(name).alias("cut"), F.ceil(F.col("orders") * F.lit(float(p))).alias("rank"))
        for name, p in zip(names, probabilities)
    ]
    sought = totals.select("*", F.inline(F.array(*wanted))).where("rank > before and rank <= before + total")
    sought = stage(sought.select(*GROUP, "range", "cut", (F.col("rank") - F.col("before")).alias("left")), "sought-ranks")
    inside = Window.partitionBy(*GROUP, "range").orderBy("n_promos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    holding = ranges.join(sought.select(*GROUP, "range").distinct(), [*GROUP, "range"], "left_semi")
    counted = holding.withColumn("upto", F.sum("n").over(inside))
    found = counted.join(sought, [*GROUP, "range"]).where("upto >= left")
    return found.groupBy(*GROUP).agg(*[F.min(F.when(F.col("cut") == name, F.col("n_promos"))).alias(name) for name in names])


def wide_percentiles(prepared: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """`exact_percentiles` for groups with very many distinct values of n_promos.

    Thresholds and means are few and joined to the bins, which partial aggregates then fold: adaptive
    execution may split the bins of a group, where a window could not.
    """
    bins = stage(promo_bins(prepared), "bins")
    cuts = cut_names("exact", probabilities)
    located = stage(wide_thresholds(bins, probabilities), "thresholds")
    weight, mean = F.col("n_amounts"), F.col("mean_amount")
    above = {cut: F.col("n_promos") >= F.col(cut) for cut in cuts}
    counts = [F.sum(F.when(above[cut], weight)).alias(f"{cut}_n") for cut in cuts]
    sums = [F.sum(F.when(above[cut], weight * mean)).alias(f"{cut}_sum") for cut in cuts]
    means = bins.join(located, GROUP).groupBy(*GROUP, *cuts).agg(*counts, *sums)
    means = means.withColumns({f"{cut}_mean": F.try_divide(f"{cut}_sum", f"{cut}_n") for cut in cuts})
    means = stage(means, "means")

    def squares(cut: str) -> Column:
        shift = mean - F.col(f"{cut}_mean")
        return F.sum(F.when(above[cut], F.col("sq_dev") + weight * shift * shift)).alias(f"{cut}_sq")

    def deviation(cut: str) -> Column:
        spread = F.coalesce(F.sqrt(F.try_divide(f"{cut}_sq", f"{cut}_n")), F.lit(0.0))
        return F.when(F.coalesce(f"{cut}_n", F.lit(0)) < 2, 0.0).otherwise(spread).alias(deviation_name(cut))

    kept = [*GROUP, *cuts, *[f"{cut}_n" for cut in cuts]]
    folded = bins.join(means, GROUP).groupBy(*kept).agg(*[squares(cut) for cut in cuts])
    return folded.select(*GROUP, *cuts, *[deviation(cut) for cut in cuts])


def stddev_above(bins: DataFrame, cuts: Sequence[str]) -> DataFrame:
    """Per (sku, month): the thresholds in the columns ``cuts``, the number of orders, and the
    population standard deviation of the amounts at or above each, 0.0 for fewer than two amounts.

    The mean above a threshold is taken first and the deviations from it second, which keeps the
    digits that a difference of squares would lose.
    """
    group, weight, mean = Window.partitionBy(*GROUP), F.col("n_amounts"), F.col("mean_amount")
    above = {cut: F.col("n_promos") >= F.col(cut) for cut in cuts}
    located = bins.withColumns({f"{cut}_n": F.sum(F.when(above[cut], weight)).over(group) for cut in cuts})
    located = located.withColumns(
        {
            f"{cut}_mean": F.try_divide(F.sum(F.when(above[cut], weight * mean)).over(group), F.col(f"{cut}_n"))
            for cut in cuts
        }
    )

    def deviation(cut: str) -> Column:
        shift = mean - F.col(f"{cut}_mean")
        squares = F.sum(F.when(above[cut], F.col("sq_dev") + weight * shift * shift))
        count = F.first(f"{cut}_n")
        spread = F.coalesce(F.sqrt(F.try_divide(squares, count)), F.lit(0.0))
        return F.when(count < 2, 0.0).otherwise(spread).alias(deviation_name(cut))

    return located.groupBy(*GROUP).agg(
        *[F.first(cut).alias(cut) for cut in cuts],
        F.sum("n").alias("total_group_orders"),
        *[deviation(cut) for cut in cuts],
    )


def approx_percentiles(
    prepared: DataFrame, probabilities: Sequence[float] = PROBABILITIES, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Approximate thresholds, number of orders and standard deviations per (sku, month)."""
    bins = with_sketched_thresholds(promo_bins(prepared, accuracy), probabilities, accuracy)
    return stddev_above(bins, cut_names("approx", probabilities))


def exact_percentiles(prepared: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Nearest-rank thresholds and standard deviations per (sku, month)."""
    bins = with_exact_thresholds(promo_bins(prepared), probabilities)
    return stddev_above(bins, cut_names("exact", probabilities)).drop("total_group_orders")


def with_differences(both: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Columns of both methods side by side, with the absolute differences last."""
    approx, exact = cut_names("approx", probabilities), cut_names("exact", probabilities)
    differences = [
        F.abs(F.col(a) - F.col(e)).alias(a.replace("_approx", "_diff"))
        for a, e in [*zip(approx, exact), *zip(map(deviation_name, approx), map(deviation_name, exact))]
    ]
    return both.select(
        *GROUP,
        *approx,
        "total_group_orders",
        *map(deviation_name, approx),
        *exact,
        *map(deviation_name, exact),
        *differences,
    )


def compare(approx: DataFrame, exact: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Join the results of both methods."""
    return with_differences(approx.join(exact, GROUP), probabilities)


def compared_percentiles(
    prepared: DataFrame, probabilities: Sequence[float] = PROBABILITIES, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """The same as `compare` of both methods, from one set of bins that carries all thresholds.

    ``prepared`` is read once: the bins carry the sketches.  They are shuffled and sorted by group once,
    for ranks, sketches, means and deviations alike.
    """
    ranked = with_exact_thresholds(promo_bins(prepared, accuracy), probabilities)
    bins = with_sketched_thresholds(ranked, probabilities, accuracy)
    cuts = cut_names("approx", probabilities) + cut_names("exact", probabilities)
    return with_differences(stddev_above(bins, cuts), probabilities)


def compared_levels(
    prepared: DataFrame, others: Sequence[float], probabilities: Sequence[float] = PROBABILITIES
) -> DataFrame:
    """Exact results at ``others`` in the place of the approximate ones, against ``probabilities``."""
    approx, exact = cut_names("approx", probabilities), cut_names("exact", probabilities)
    bins = with_exact_thresholds(promo_bins(prepared), others)
    bins = bins.withColumnsRenamed(dict(zip(cut_names("exact", others), approx)))
    bins = with_exact_thresholds(bins, probabilities)
    return with_differences(stddev_above(bins, approx + exact), probabilities)


def difference_report(compared: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Groups in all, and number and percentage of those whose P90 threshold or deviation differ."""
    thresh, stddev = F.col("p90_thresh_diff") > tolerance, F.col("p90_stddev_diff") > tolerance
    groups = F.count("*")
    return compared.agg(
        groups.alias("n_groups"),
        F.count_if(thresh).alias("n_thresh_diff"),
        F.count_if(stddev).alias("n_stddev_diff"),
        F.round(F.try_divide(F.count_if(thresh), groups) * 100, 2).alias("pct_thresh_diff"),
        F.round(F.try_divide(F.count_if(stddev), groups) * 100, 2).alias("pct_stddev_diff"),
    )


def largest_differences(compared: DataFrame) -> DataFrame:
    """The largest absolute difference of each measure."""
    columns = [c for c in compared.columns if c.endswith("_diff")]
    return compared.agg(*[F.max(c).alias(f"max_{c}") for c in columns])


def deviation_profile(compared: DataFrame) -> DataFrame:
    """Number of groups, and of those whose exact P90 deviation is above zero."""
    return compared.agg(
        F.count("*").alias("n_groups"),
        F.count_if(F.col("p90_stddev_exact") > 0).alias("n_nonzero_stddev"),
    )


def preview(compared: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` groups in the order of sku and month."""
    return compared.orderBy(*GROUP).limit(n)


def nonzero_deviation(compared: DataFrame) -> DataFrame:
    """Groups whose exact P90 deviation is above zero."""
    return compared.filter("p90_stddev_exact > 0")
