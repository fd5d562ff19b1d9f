import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ordermill.operators import promos
from ordermill.plans import reports
from ordermill.session import stage
from ordermill.sources import orders

NAMES = [
    "index", "Date", "Status", "Fulfilment", "Courier Status", "ship-service-level",
    "ship-state", "ship-city", "Amount", "promotion-ids",
]
GOLDEN = [
    ("0", "04-01-22", "Shipped", "Merchant", "Shipped", "Expedited", "KA", "X", "100", "P1,P2,P3"),
    ("1", "04-03-22", "Cancelled", "Amazon", None, "Standard", "KA", "blr ", "50", "P1, P2,,P1"),
    ("2", "04-03-22", "Cancelled", "Amazon", None, "Standard", "KA", "BLR", None, None),
    ("3", "04-03-22", "Cancelled", "Amazon", None, "Standard", "GOA", "PANJIM", "10", "P1,P2,P2"),
    ("4", "04-02-22", "Pending", "Amazon", None, "Standard", "KA", "MYS", "10", "P3"),
    ("5", "04-03-22", "Cancelled", "Amazon", None, "Standard", "KA", None, "10", "P1,P2,P1"),
    ("6", "04-03-22", "Cancelled", "Amazon", None, "Expedited", "KA", "BLR", "10", "P1,P2,P1"),
    ("7", "04-03-22", "Cancelled", "Amazon", None, "Standard", "KA", "BLR", "10", "P1,P4,P2"),
]


@pytest.fixture(scope="module")
def golden(raw_orders):
    return orders.promo_orders(raw_orders([dict(zip(NAMES, r)) for r in GOLDEN]))


def test_lifespans(golden):
    lifespans = promos.promo_lifespan(golden)
    assert rows(lifespans, "promo", "active_days") == [("P1", 2), ("P2", 2), ("P3", 1), ("P4", 0)]
    assert rows(promos.valid_promos(lifespans), "promo") == [("P1",), ("P2",)]


def test_state_threshold(golden):
    assert rows(promos.state_threshold(golden)) == [("KA", 100.0)]


def test_valid_counts(golden):
    counted = promos.with_valid_count(promos.cancelled_candidates(golden), promos.promo_lifespan(golden))
    assert rows(counted, "row_id", "n_valid") == [(1, 3), (2, 0), (3, 3), (5, 3), (7, 2)]


def test_city_share(golden):
    assert rows(reports.cancelled_share(golden)) == [("BLR", 3, 1, 33.3333), ("PANJIM", 1, 0, 0.0)]


def test_city_totals(golden):
    assert tuple(promos.city_totals(reports.cancelled_share(golden)).first()) == (2, 4, 1, 1)


def test_use_without_a_date_counts_for_the_order_but_not_the_lifespan(raw_orders):
    data = [
        ("0", "04-01-22", "Pending", "", "", "", "KA", "BLR", "1", "P1"),
        ("1", "04-09-22", "Pending", "", "", "", "KA", "BLR", "1", "P1"),
        ("2", "bad", "Cancelled", "", "", "Standard", "KA", "BLR", "1", "P1,P1,P9"),
    ]
    frame = orders.promo_orders(raw_orders([dict(zip(NAMES, r)) for r in data]))
    lifespans = promos.promo_lifespan(frame)
    assert rows(lifespans, "promo") == [("P1",)]
    counted = promos.with_valid_count(promos.cancelled_candidates(frame), lifespans)
    assert rows(counted, "row_id", "n_valid") == [(2, 2)]


def test_orders_without_id_stay_in_the_denominator(raw_orders):
    order = ("x", "04-03-22", "Cancelled", "Amazon", None, "Standard", "KA", "BLR", "10", "P1,P2,P1")
    data = [dict(zip(NAMES, r)) for r in [*GOLDEN, order, order, order[:-1] + (None,)]]
    frame = orders.promo_orders(raw_orders(data))
    assert rows(reports.cancelled_share(frame)) == [("BLR", 6, 1, 16.6667), ("PANJIM", 1, 0, 0.0)]


def test_rows_of_one_id_share_the_count(raw_orders):
    order = ("8", "04-03-22", "Cancelled", "Amazon", None, "Standard", "KA", "HUBLI", "10", "P1,P2")
    frame = orders.promo_orders(raw_orders([dict(zip(NAMES, r)) for r in [*GOLDEN, order, order]]))
    expected = [("BLR", 3, 1, 33.3333), ("HUBLI", 2, 2, 100.0), ("PANJIM", 1, 0, 0.0)]
    assert rows(reports.cancelled_share(frame)) == expected
    assert rows(promos.city_share(reports.qualified_orders(frame))) == expected


def test_cities_come_in_order(golden):
    assert [r["city"] for r in reports.cancelled_share(golden).collect()] == ["BLR", "PANJIM"]


def test_no_code_is_needed_if_none_is_asked_for(golden):
    assert rows(reports.cancelled_share(golden, min_valid=0), "city", "qualified_orders") == [("BLR", 2), ("PANJIM", 0)]


def skewed_orders(spark, n=900):
    """Orders where one code holds most uses, one state most orders, and many have no code."""
    rng = random.Random(5)
    data = []
    for i in range(n):
        codes = rng.choice([None, ",, ,", "HOT,HOT,,HOT", f"HOT,C{rng.randint(1, 60)}", f"C{rng.randint(1, 60)}, C{i}"])
        data.append((
            i, dt.date(2022, 4, 1) + dt.timedelta(days=rng.randint(0, 9)), rng.choice(["Cancelled", "Shipped"]),
            rng.choice(["Merchant", "Amazon"]), "Shipped", "Standard",
            rng.choice(["KA", "KA", "KA", "GOA", None]), rng.choice(["BLR", "MYS", "PANJIM"]),
            rng.choice([None, float(rng.randint(1, 99))]), codes,
        ))
    schema = (
        "row_id long, order_date date, status string, fulfilment string, courier_status string, "
        "service_level string, state string, city string, amount double, promotion_ids string"
    )
    return data, spark.createDataFrame(data, schema)


def test_counts_agree_with_brute_force(spark):
    data, frame = skewed_orders(spark)
    lifespans, thresholds = promos.promo_lifespan(frame), promos.state_threshold(frame)
    lifespans, thresholds = stage(lifespans, "lifespans"), stage(thresholds, "thresholds")

    days, averages = {}, {}
    for row in data:
        for code in (c.strip() for c in (row[9] or "").split(",")):
            if code:
                days.setdefault(code, []).append(row[1])
        if row[3] == "Merchant" and row[6] and row[8] is not None:
            averages.setdefault(row[6], []).append(row[8])
    valid = {c for c, d in days.items() if (max(d) - min(d)).days >= 2}
    average = {s: sum(a) / len(a) for s, a in averages.items()}
    expected = []
    for row in data:
        if row[2] == "Cancelled":
            n = sum(c.strip() in valid for c in (row[9] or "").split(","))
            meets = n >= 3 and row[8] is not None and row[6] in average and row[8] < average[row[6]]
            expected.append((row[0], n, int(meets)))
    expected.sort(key=lambda t: tuple(map(str, t)))
    assert any(flag for _, _, flag in expected)

    candidates = promos.cancelled_candidates(frame)
    cities = {row[0]: row[7] for row in data}
    share = []
    for city in ("BLR", "MYS", "PANJIM"):
        flags = [flag for row_id, _, flag in expected if cities[row_id] == city]
        share.append((city, len(flags), sum(flags)))
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (default, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            flagged = promos.with_qualified(promos.with_valid_count(candidates, lifespans), thresholds)
            assert rows(flagged, "row_id", "n_valid", "qualified") == expected
            assert rows(promos.city_share(flagged), "city", "total_orders", "qualified_orders") == share
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)


@pytest.mark.parametrize("hot", [3, 1100])  # a code with a third of all uses, and with just under a thousandth
def test_hot_codes_and_missing_ids_leave_no_large_task(spark, hot):
    n = 120_000
    promo = F.when(F.col("id") % hot == 0, "HOT").otherwise(F.concat(F.lit("C"), (F.col("id") % 5000).cast("string")))
    candidates = spark.range(n).select(
        F.when(F.col("id") % 3 != 1, F.col("id")).alias("row_id"),
        F.lit("X").alias("city"), F.lit("KA").alias("state"), F.lit(1.0).alias("amount"), promo.alias("promotion_ids"),
    )
    codes = spark.range(5000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("promo"))
    lifespans = codes.unionByName(spark.createDataFrame([("HOT",)], "promo string")).withColumn("active_days", F.lit(9))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "48k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        counted = promos.with_valid_count(candidates, stage(lifespans, "lifespans"))
        sizes = [r["count"] for r in counted.groupBy(F.spark_partition_id()).count().collect()]
        assert counted.filter("n_valid = 1").count() == n - n // 3
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == n and max(sizes) < n / 6
