"""The order frames derived from a star schema (lineitem, orders, customer, nation, part).

These are the inputs of the registered queries.  Each reads whole tables and projects the
columns it needs before the joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.schema import DATE_PATTERN, ORDER_COLUMNS, SIZES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _customer_states(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).drop("n_nationkey", "c_nationkey")


def _text(col: Column) -> Column:
    return col.cast("string")


def sales_line(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line, in the shape of the order table.

    Orders get their state before the lines come in, which spares the lines a shuffle by customer.
    """
    lines = table(spark, folder, "lineitem")
    customers = _customer_states(spark, folder).drop("c_mktsegment")
    orders = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_size")
    size = F.element_at(F.array(*map(F.lit, ["Free", *SIZES])), F.col("p_size") % 11 + 1)
    return (
        lines.join(orders.select("o_orderkey", "state"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_shipdate").cast("date").alias("order_date"),
            F.when(F.col("l_returnflag") == "A", "Cancelled")
            .when(F.col("l_returnflag") == "R", "Shipped - Returned to Seller")
            .otherwise("Shipped")
            .alias("status"),
            "state",
            F.col("p_type").alias("style"),
            F.concat("p_type", F.lit("-"), _text(F.col("p_partkey"))).alias("sku"),
            size.alias("size"),
            F.col("l_quantity").alias("qty"),
            F.col("l_quantity").cast("int").alias("whole_qty"),
        )
    )


def brand_line(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line with the part's brand as its sku."""
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("sku"),
        F.col("l_shipdate").cast("date").alias("order_date"),
        F.round(F.col("l_discount") * 100).cast("int").alias("n_promos"),
        F.col("l_extendedprice").alias("amount"),
    )


def sales_order(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order, with up to five promotion codes derived from its key."""
    key = F.col("o_orderkey")
    # the second of the five codes has a leading space
    codes = [
        F.when(
            key % 6 >= n,
            F.concat(F.lit(" PROMO-" if n == 2 else "PROMO-"), _text((key * 31 + 17 * n) % 20000)),
        )
        for n in range(1, 6)
    ]
    return (
        table(spark, folder, "orders")
        .join(_customer_states(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.alias("row_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.when(F.col("o_orderstatus") == "F", "Cancelled")
            .when(F.col("o_orderstatus") == "O", "Shipped")
            .otherwise("Pending")
            .alias("status"),
            F.when(key % 2 == 0, "Merchant").otherwise("Amazon").alias("fulfilment"),
            F.when(F.col("o_orderstatus") == "O", "Shipped").otherwise("Unshipped").alias("courier_status"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Expedited")
            .otherwise("Standard")
            .alias("service_level"),
            "state",
            F.concat("state", F.lit("/"), "c_mktsegment").alias("city"),
            F.col("o_totalprice").alias("amount"),
            F.nullif(F.concat_ws(",", *codes), F.lit("")).alias("promotion_ids"),
        )
    )


def _raw(df: DataFrame, **cells: Column) -> DataFrame:
    """The raw order table, all strings, from the columns named as in `cells`."""
    known = {name.lower().replace("-", "_").replace(" ", "_"): name for name in ORDER_COLUMNS}
    columns = {known[key]: value for key, value in cells.items()}
    return df.select(*[_text(columns.get(name, F.lit(None))).alias(name) for name in ORDER_COLUMNS])


def raw_sales_order(spark: SparkSession, folder: str) -> DataFrame:
    """`sales_order` as raw text, with untidy places, and with quotes, spaces at the edge and line ends
    inside the list of codes."""
    key, codes = F.col("row_id"), F.col("promotion_ids")
    return _raw(
        sales_order(spark, folder),
        index=key,
        order_id=F.concat(F.lit("O-"), _text(key)),
        date=F.date_format("order_date", DATE_PATTERN),
        status=F.col("status"),
        fulfilment=F.col("fulfilment"),
        ship_service_level=F.col("service_level"),
        courier_status=F.col("courier_status"),
        amount=F.col("amount"),
        ship_city=F.concat(F.lit(" "), F.lower("city")),
        ship_state=F.concat(F.lower("state"), F.lit("  ")),
        promotion_ids=F.when(key % 4 == 1, F.concat(codes, F.lit(',"Q"')))
        .when(key % 4 == 3, F.concat(F.lit("  L1\nL2, "), codes))
        .otherwise(codes),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """`sales_line` as CSV lines; odd quantities have a decimal point, unsized articles ship on
    February 31, and 13 pieces go to no state.  Among them stand headers, blank and short lines."""
    year = F.date_format("order_date", "yy")
    raw = _raw(
        sales_line(spark, folder),
        date=F.when(F.col("size") == "Free", F.concat(F.lit("02-31-"), year)).otherwise(
            F.date_format("order_date", DATE_PATTERN)
        ),
        status=F.col("status"),
        style=F.col("style"),
        sku=F.col("sku"),
        size=F.concat(F.lit("\t"), F.col("size")),
        qty=F.when(F.col("qty") % 2 == 0, _text(F.col("whole_qty"))).otherwise(_text(F.col("qty"))),
        ship_state=F.when(F.col("qty") != 13, F.concat(F.lit(" "), F.lower("state"))),
        ship_country=F.lit('IN, "India"'),
    )
    keep = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines = raw.select(F.to_csv(F.struct(*[f"`{name}`" for name in ORDER_COLUMNS]), keep).alias("value"))
    header = ",".join(ORDER_COLUMNS)
    dropped = [header, header.replace(ORDER_COLUMNS[0], "row"), " \t", '1,"a,b,c,d,e,f,g,h,i,j,k,l,m,n,o,p,q,r,s",04-01-22,Shipped']
    noise = table(spark, folder, "nation").select(F.explode(F.array(*map(F.lit, dropped))).alias("value"))
    return lines.unionByName(noise)


def dirty_state(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with the nation name in one of six spellings, one of them null."""
    name, spelling = F.col("state"), F.col("c_custkey") % 6
    return _customer_states(spark, folder).select(
        F.col("c_custkey").alias("row_id"),
        F.col("c_mktsegment").alias("city"),
        F.when(spelling == 0, name)
        .when(spelling == 1, F.lower(name))
        .when(spelling == 2, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(spelling == 3, F.replace(name, F.lit("NATION_"), F.lit("N")))
        .when(spelling == 5, F.replace(name, F.lit("_"), F.lit(" ")))
        .alias("state_raw"),
    )


def state_alias(spark: SparkSession, folder: str) -> DataFrame:
    """alias -> canon, unique on alias; the short form is known for the first 20 nations only."""
    nation = table(spark, folder, "nation")
    short = nation.filter("n_nationkey < 20").select(
        F.replace("n_name", F.lit("NATION_"), F.lit("N")).alias("alias"), F.col("n_name").alias("canon")
    )
    spaced = nation.select(F.replace("n_name", F.lit("_"), F.lit(" ")).alias("alias"), F.col("n_name").alias("canon"))
    return short.unionAll(spaced)


def event_orders(events: DataFrame) -> DataFrame:
    """Events as orders: the type is the state, the user picks the size, the property k is the quantity."""
    size = F.element_at(F.array(*map(F.lit, ["Free", *SIZES])), (F.col("user_id") % 11 + 1).cast("int"))
    # event times carry no zone and are read as UTC, whatever the zone of the session
    ordered_at = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    return events.select(
        F.col("event_type").alias("state"),
        ordered_at.alias("ordered_at"),
        size.alias("size"),
        F.get_json_object("props", "$.k").try_cast("int").alias("qty"),
    )
