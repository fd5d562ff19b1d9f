"""Every registered query against its SQL on the smallest tables, and checks on the plans."""

import re
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from ordermill import session
from ordermill.oracles import ORACLES
from ordermill.queries import QUERIES
from ordermill.sources import star

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) == 47
    assert QUERIES.items() <= driver.queries().items() and ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    result = QUERIES[name](spark, str(FOLDER))
    if not name.startswith("stream_"):
        assert not re.search("CartesianProduct|NestedLoopJoin|PythonUDF|InPandas|CollectLimit", plan_of(result))
    got, expected = result.toPandas(), tables.sql(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    got, expected = (f[columns].sort_values(columns).reset_index(drop=True) for f in (got, expected))
    pd.testing.assert_frame_equal(got, expected, check_exact=True)


def test_reports_are_not_about_zeros(spark):
    report = QUERIES["pct_diff_levels"](spark, str(FOLDER)).first()
    assert report["n_thresh_diff"] > 0 and report["n_stddev_diff"] > 0
    assert all(v > 0 for v in QUERIES["pct_max_diff_levels"](spark, str(FOLDER)).first())


@pytest.mark.parametrize(
    "name", ["stddev_nonzero", "stddev_profile", "stddev_above_approx", "pct_diff_report", "pct_max_diff"]
)
def test_one_scan_for_both_methods(spark, name):
    assert plan_of(QUERIES[name](spark, str(FOLDER))).count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", ["city_cancel_pct", "city_totals", "qualified_orders", "valid_promo_count"])
def test_orders_are_read_once(spark, monkeypatch, name):
    """Only the first staged table reads the orders; all else reads staged tables."""
    plans = []
    write = session._stage
    monkeypatch.setattr(session, "_stage", lambda df, path: plans.append(plan_of(df)) or write(df, path))
    plans.append(plan_of(QUERIES[name](spark, str(FOLDER))))
    assert [plan.count("orders.parquet") for plan in plans] == [1] + [0] * (len(plans) - 1)


def test_both_window_lengths_occur(spark):
    lengths = rows_of(QUERIES["state_window_length"](spark, str(FOLDER)))
    assert {days for _, days in lengths} == {5, 10}


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["state", "window_date", "size"] and result.count() > 0


def test_scans_read_only_the_columns_they_need(spark):
    plan = QUERIES["shipped_state_volume"](spark, str(FOLDER))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    line = next(s for s in schemas if "l_orderkey" in s)
    assert sorted(c.split(":")[0] for c in line.split(",")) == ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"]
    assert all("c_name" not in s and "p_retailprice" not in s for s in schemas)


@pytest.mark.parametrize("name", ["city_cancel_pct", "window_top_size", "stddev_nonzero", "median_variety"])
def test_results_do_not_depend_on_the_join_strategy(spark, name):
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    expected = QUERIES[name](spark, str(FOLDER)).toPandas()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = QUERIES[name](spark, str(FOLDER))
        assert "SortMergeJoin" in plan_of(merged)
        got = merged.toPandas()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)
    columns = list(expected.columns)
    got, expected = (f.sort_values(columns).reset_index(drop=True) for f in (got, expected))
    pd.testing.assert_frame_equal(got, expected)


def test_hot_window_state_meets_only_daily_totals(spark):
    """The fan-out over window dates reads the staged daily totals, not the order lines."""
    plan = plan_of(QUERIES["window_top_size"](spark, str(FOLDER)))
    assert "lineitem" not in plan and "daily-" in plan


def test_star_views_keep_every_line(spark):
    lines = star.table(spark, str(FOLDER), "lineitem").count()
    assert star.sales_line(spark, str(FOLDER)).count() == lines
    assert star.brand_line(spark, str(FOLDER)).count() == lines
