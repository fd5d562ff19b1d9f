import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ordermill.operators import windows
from ordermill.plans import reports
from ordermill.sources import orders

D = dt.date

GOLDEN = [
    ("04-01-22", "Shipped", "M", "1", "ka"),
    ("04-01-22", "Shipped - Delivered to Buyer", "S", "2", "KA"),
    ("04-02-22", "Shipped", "S", "2", " KA "),
    ("04-02-22", "SHIPPED", "M", "3", "KA"),
    ("13-01-22", "Shipped", "L", "1", "GOA"),
    ("04-05-22", "Cancelled", "L", "1", "GOA"),
    ("04-05-22", "Shipped", "XL", "0", "GOA"),
    ("04-05-22", "Shipped", "L", "1.0", "GOA"),
    ("04-05-22", "Shipped", None, "2", "GOA"),
    ("04-05-22", "Shipped", "M", "2", None),
    ("04-05-22", "Shipped", "S", "NaN", "GOA"),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def golden(raw_orders):
    names = ["Date", "Status", "Size", "Qty", "ship-state"]
    return orders.window_orders(raw_orders([dict(zip(names, r)) for r in GOLDEN]))


def test_volume_needs_a_whole_quantity_but_no_size_or_date(golden):
    expected = [("GOA", 2), ("KA", 4)]
    assert rows(windows.shipped_state_volume(golden)) == expected
    assert rows(windows.volume_of(windows.daily_totals(golden))) == expected


def test_window_lengths(golden):
    lengths = windows.window_lengths(windows.shipped_state_volume(golden), cutoff=3, short=2, long=3)
    assert rows(lengths) == [("GOA", 3), ("KA", 2)]


def test_window_lengths_are_positive(golden):
    with pytest.raises(ValueError):
        windows.window_lengths(windows.shipped_state_volume(golden), short=0)


def test_state_without_volume_gets_the_default(spark, golden):
    none = spark.createDataFrame([], "state string, window_days int")
    assert {r.window_days for r in windows.with_window_length(golden, none).collect()} == {10}


def test_popular_sizes(golden):
    assert rows(reports.popular_sizes(golden, cutoff=3, short=2, long=3)) == [
        ("GOA", D(2022, 4, 6), "L"),
        ("GOA", D(2022, 4, 7), "L"),
        ("GOA", D(2022, 4, 8), "L"),
        ("KA", D(2022, 4, 2), "M"),
        ("KA", D(2022, 4, 3), "S"),
        ("KA", D(2022, 4, 4), "M"),
    ]


def test_dates_as_text_sort_by_date(spark):
    sizes = spark.createDataFrame(
        [("KA", D(2023, 1, 2), "M"), ("KA", D(2022, 12, 31), "S"), ("GOA", D(2024, 5, 1), "L")],
        "state string, window_date date, size string",
    )
    got = [tuple(r) for r in reports.dates_as_text(sizes).collect()]
    assert got == [("GOA", "05-01-24", "L"), ("KA", "12-31-22", "S"), ("KA", "01-02-23", "M")]


def test_unshipped_counts_as_shipped(spark):
    frame = spark.createDataFrame(
        [("KA", D(2022, 4, 1), "Unshipped", "M", 1.0, 1)],
        "state string, order_date date, status string, size string, qty double, whole_qty int",
    )
    assert windows.shipped_orders(frame).count() == 1


def random_orders(spark, seed, whole=True, n=600):
    rng = random.Random(seed)
    data = [
        (
            # one state holds most of the orders
            rng.choice(["KA"] * 6 + ["GOA", "TN", "MH"]),
            D(2022, 4, 1) + dt.timedelta(days=rng.choice([0, 1, 2, 3, 5, 8, 30])),
            rng.choice(["Shipped", "Shipped", "Cancelled"]),
            rng.choice(["S", "M", "L", "XL", "3XL"]),
            float(rng.randint(0, 4)) if whole else rng.randint(0, 40) / 8,
            rng.randint(0, 4),
        )
        for _ in range(n)
    ]
    return data, spark.createDataFrame(
        data, "state string, order_date date, status string, size string, qty double, whole_qty int"
    )


def brute_force(data, cutoff, short, long):
    shipped = [r for r in data if "shipped" in r[2].lower()]
    volume = {}
    for r in shipped:
        volume[r[0]] = volume.get(r[0], 0) + (r[5] > 0)
    buckets = {}
    for state, day, _, size, qty, _ in shipped:
        if qty > 0:
            for i in range(1, (short if volume[state] > cutoff else long) + 1):
                buckets.setdefault((state, day + dt.timedelta(days=i)), {}).setdefault(size, []).append(qty)
    result = []
    for (state, day), sizes in buckets.items():
        most = max(map(len, sizes.values()))
        spread = {s: statistics.pvariance(q) for s, q in sizes.items() if len(q) == most}
        least = min(spread.values())
        result.append((state, day, min(s for s, v in spread.items() if v - least < 1e-9)))
    return sorted(result)


@pytest.mark.parametrize("seed,whole", [(1, True), (2, True), (3, False)])
def test_popular_sizes_by_brute_force(spark, seed, whole):
    data, frame = random_orders(spark, seed, whole)
    got = reports.popular_sizes(frame, cutoff=60, short=3, long=6)
    assert rows(got) == brute_force(data, 60, 3, 6)


def test_daily_totals_first_equals_fan_out_of_orders(spark):
    _, frame = random_orders(spark, 4)
    daily = windows.daily_totals(frame)
    lengths = windows.window_lengths(windows.volume_of(daily), 60, 3, 6)
    direct = (
        windows.with_window_length(windows.shipped_orders(frame), lengths)
        .withColumn("ahead", F.explode(F.sequence(F.lit(1), "window_days")))
        .groupBy("state", F.date_add("order_date", F.col("ahead")).alias("window_date"), "size")
        .agg(F.count("*").alias("n"), F.sum("qty").alias("sum_qty"), F.sum(F.col("qty") ** 2).alias("sum_qty_sq"))
    )
    assert rows(windows.window_totals(daily, lengths)) == rows(direct)


def test_fixed_length_equals_time_window(spark):
    _, frame = random_orders(spark, 5)
    fixed = windows.window_totals(windows.daily_totals(frame), spark.createDataFrame([], "state string, window_days int"), 5)
    period = F.window(F.col("order_date").cast("timestamp"), "5 days", "1 day")
    direct = (
        windows.shipped_orders(frame)
        .groupBy("state", period.alias("p"), "size")
        .agg(F.count("*").alias("n"))
        .select("state", F.to_date("p.end").alias("window_date"), "size", "n")
    )
    assert rows(fixed, "state", "window_date", "size", "n") == rows(direct)


def test_variance_agrees_with_var_pop(spark):
    _, frame = random_orders(spark, 6, whole=False)
    one_day = spark.createDataFrame([(s, 1) for s in ("KA", "GOA", "TN", "MH")], "state string, window_days int")
    got = windows.with_variance(windows.window_totals(windows.daily_totals(frame), one_day))
    direct = windows.shipped_orders(frame).groupBy("state", "order_date", "size").agg(F.var_pop("qty").alias("v"))
    joined = got.join(direct.withColumn("window_date", F.date_add("order_date", 1)), ["state", "window_date", "size"])
    assert joined.count() == got.count()
    assert joined.filter(F.abs(F.col("variance") - F.col("v")) > 1e-9).count() == 0


def test_close_variances_tie_by_name(spark):
    totals = spark.createDataFrame(
        [
            ("KA", D(2022, 4, 1), "M", 2, 4.0, 8.0 + 1e-10),
            ("KA", D(2022, 4, 1), "L", 2, 4.0, 8.0 + 2e-10),
            ("KA", D(2022, 4, 1), "A", 2, 4.0, 8.1),
            ("KA", D(2022, 4, 1), "3XL", 1, 2.0, 4.0),
        ],
        "state string, window_date date, size string, n long, sum_qty double, sum_qty_sq double",
    )
    assert rows(windows.top_size(totals)) == [("KA", D(2022, 4, 1), "L")]


def test_a_variance_that_is_no_number_loses(spark):
    inf = float("inf")
    totals = spark.createDataFrame(
        [
            ("KA", D(2022, 4, 1), "A", 1, inf, inf), ("KA", D(2022, 4, 1), "M", 1, 2.0, 4.0),
            ("KA", D(2022, 4, 2), "S", 1, inf, inf), ("KA", D(2022, 4, 2), "L", 1, inf, inf),
            ("KA", D(2022, 4, 3), "B", 2, inf, inf), ("KA", D(2022, 4, 3), "A", 1, 2.0, 4.0),
        ],
        "state string, window_date date, size string, n long, sum_qty double, sum_qty_sq double",
    )
    assert rows(windows.top_size(totals)) == [
        ("KA", D(2022, 4, 1), "M"), ("KA", D(2022, 4, 2), "L"), ("KA", D(2022, 4, 3), "B")
    ]


def test_cutoff_follows_the_data(spark):
    volume = spark.createDataFrame([("KA", 10), ("GOA", 20), ("TN", 90)], "state string, n_orders long")
    lengths = windows.window_lengths(volume, windows.mean_volume(volume))
    assert rows(lengths) == [("GOA", 10), ("KA", 10), ("TN", 5)]
    assert windows.mean_volume(volume.limit(0)) == 0.0
