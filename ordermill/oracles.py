"""The same queries in SQL, each by the plain definition of its operator, for the results check."""

from __future__ import annotations

SALES_LINE = """
sales_line AS (
  SELECT CAST(l_shipdate AS DATE) AS order_date,
    CASE l_returnflag WHEN 'A' THEN 'Cancelled' WHEN 'R' THEN 'Shipped - Returned to Seller'
      ELSE 'Shipped' END AS status,
    n_name AS state, p_type AS style, p_type || '-' || CAST(p_partkey AS VARCHAR) AS sku,
    CASE p_size % 11 WHEN 0 THEN 'Free' WHEN 1 THEN 'XS' WHEN 2 THEN 'S' WHEN 3 THEN 'M' WHEN 4 THEN 'L'
      WHEN 5 THEN 'XL' WHEN 6 THEN 'XXL' WHEN 7 THEN '3XL' WHEN 8 THEN '4XL' WHEN 9 THEN '5XL'
      ELSE '6XL' END AS size,
    l_quantity AS qty, l_extendedprice AS amount, p_brand AS brand,
    CAST(round(l_discount * 100) AS INTEGER) AS n_promos
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""

SALES_ORDER = """
sales_order AS (
  SELECT o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS order_date,
    CASE o_orderstatus WHEN 'F' THEN 'Cancelled' WHEN 'O' THEN 'Shipped' ELSE 'Pending' END AS status,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Merchant' ELSE 'Amazon' END AS fulfilment,
    CASE WHEN o_orderstatus = 'O' THEN 'Shipped' ELSE 'Unshipped' END AS courier_status,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Expedited' ELSE 'Standard' END AS service_level,
    n_name AS state, n_name || '/' || c_mktsegment AS city, o_totalprice AS amount,
    nullif(concat_ws(',',
      CASE WHEN o_orderkey % 6 >= 1 THEN 'PROMO-'  || CAST((o_orderkey * 31 + 17) % 20000 AS VARCHAR) END,
      CASE WHEN o_orderkey % 6 >= 2 THEN ' PROMO-' || CAST((o_orderkey * 31 + 34) % 20000 AS VARCHAR) END,
      CASE WHEN o_orderkey % 6 >= 3 THEN 'PROMO-'  || CAST((o_orderkey * 31 + 51) % 20000 AS VARCHAR) END,
      CASE WHEN o_orderkey % 6 >= 4 THEN 'PROMO-'  || CAST((o_orderkey * 31 + 68) % 20000 AS VARCHAR) END,
      CASE WHEN o_orderkey % 6 >= 5 THEN 'PROMO-'  || CAST((o_orderkey * 31 + 85) % 20000 AS VARCHAR) END),
      '') AS promotion_ids
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

TYPED_ORDERS = """SELECT row_id,
  strftime(make_date(2000 + year(order_date) % 100, month(order_date), day(order_date)), '%Y-%m-%d') AS order_date,
  upper(city) AS city, upper(state) AS state, amount,
  CASE row_id % 4 WHEN 1 THEN promotion_ids || ',"Q"' WHEN 3 THEN '  L1' || chr(10) || 'L2, ' || promotion_ids
    ELSE promotion_ids END AS promotion_ids,
  CAST(CASE WHEN promotion_ids IS NULL THEN 0 ELSE len(string_split(promotion_ids, ',')) + row_id % 2 END AS INTEGER)
    AS n_promos
FROM sales_order"""

STATES = """
dirty_state AS (
  SELECT c_custkey AS row_id, c_mktsegment AS city,
    CASE c_custkey % 6 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) WHEN 2 THEN '  ' || n_name || ' '
      WHEN 3 THEN replace(n_name, 'NATION_', 'N') WHEN 4 THEN NULL
      ELSE replace(n_name, '_', ' ') END AS state_raw
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
state_alias AS (
  SELECT replace(n_name, 'NATION_', 'N') AS alias, n_name AS canon FROM nation WHERE n_nationkey < 20
  UNION ALL SELECT replace(n_name, '_', ' '), n_name FROM nation),
named AS (
  SELECT row_id, city, coalesce(canon, upper(trim(state_raw))) AS state
  FROM dirty_state LEFT JOIN state_alias ON alias = upper(trim(state_raw))),
spelled AS (
  SELECT row_id, city,
    CASE WHEN state = 'N21' AND city = 'BUILDING' THEN 'NATION_21'
      WHEN state = 'N22' AND city = 'MACHINERY' THEN 'NATION_22' ELSE state END AS state
  FROM named)"""

WINDOWS = f"""{SALES_LINE},
volume AS (
  SELECT state, count(*) AS n_orders FROM sales_line
  WHERE lower(status) LIKE '%shipped%' AND qty > 0 AND state <> '' GROUP BY state),
lengths AS (
  SELECT state, CASE WHEN n_orders > (SELECT avg(n_orders) FROM volume) THEN 5 ELSE 10 END AS window_days FROM volume),
shipped AS (
  SELECT state, order_date, size, qty FROM sales_line
  WHERE lower(status) LIKE '%shipped%' AND qty > 0 AND state <> '' AND size <> '' AND order_date IS NOT NULL)"""

TOTALS = f"""{WINDOWS},
totals AS (
  SELECT shipped.state, CAST(order_date + CAST(ahead AS INTEGER) AS DATE) AS window_date, size,
    count(*) AS n, sum(qty) AS sum_qty, sum(qty * qty) AS sum_qty_sq
  FROM shipped JOIN lengths ON shipped.state = lengths.state JOIN generate_series(1, 10) AS days(ahead)
    ON ahead <= window_days
  GROUP BY ALL),
measured AS (SELECT *, sum_qty_sq / n - (sum_qty / n) * (sum_qty / n) AS variance FROM totals)"""

TOP_SIZE = """, most AS (
  SELECT * FROM (SELECT *, max(n) OVER (PARTITION BY state, window_date) AS max_n FROM measured)
  WHERE n = max_n),
steady AS (
  SELECT * FROM (SELECT *, min(variance) OVER (PARTITION BY state, window_date) AS min_variance FROM most)
  WHERE abs(variance - min_variance) < 1e-9)
SELECT state, strftime(window_date, '%Y-%m-%d') AS window_date, min(size) AS size
FROM steady GROUP BY state, window_date"""

VARIETY = f"""{SALES_LINE},
skus AS (
  SELECT strftime(order_date, '%Y-%m') AS month, state, style, sku,
    max(CASE size WHEN 'XS' THEN 1 WHEN 'S' THEN 2 WHEN 'M' THEN 3 WHEN 'L' THEN 4 WHEN 'XL' THEN 5
      WHEN 'XXL' THEN 6 WHEN '3XL' THEN 7 WHEN '4XL' THEN 8 WHEN '5XL' THEN 9 ELSE 10 END) AS max_rank
  FROM sales_line
  WHERE size <> 'Free' AND order_date IS NOT NULL AND state <> '' AND style <> '' AND sku <> ''
  GROUP BY ALL),
styles AS (
  SELECT "month", state, style, count(DISTINCT sku) AS variety, max(max_rank) AS max_rank
  FROM skus GROUP BY ALL HAVING max(max_rank) >= 6)"""

PROMOS = f"""{SALES_ORDER},
tokens AS (
  SELECT row_id, order_date, trim(code) AS promo
  FROM (SELECT row_id, order_date, unnest(string_split(promotion_ids, ',')) AS code FROM sales_order)
  WHERE trim(code) <> ''),
lifespan AS (
  SELECT promo, min(order_date) AS first_d, max(order_date) AS last_d, count(*) AS n_tokens,
    date_diff('day', min(order_date), max(order_date)) AS active_days
  FROM tokens WHERE order_date IS NOT NULL GROUP BY promo),
threshold AS (
  SELECT upper(trim(state)) AS state, avg(amount) AS state_avg FROM sales_order
  WHERE fulfilment = 'Merchant' AND courier_status = 'Shipped' AND trim(state) <> ''
  GROUP BY ALL),
candidates AS (
  SELECT row_id, upper(trim(city)) AS city, upper(trim(state)) AS state, amount, promotion_ids FROM sales_order
  WHERE lower(status) LIKE '%cancelled%' AND service_level = 'Standard'),
valid_count AS (
  SELECT tokens.row_id, count(*) AS n_valid
  FROM candidates JOIN tokens ON candidates.row_id = tokens.row_id JOIN lifespan ON tokens.promo = lifespan.promo
  WHERE active_days >= 2 GROUP BY tokens.row_id),
qualified AS (
  SELECT candidates.row_id, city, candidates.state, amount, coalesce(n_valid, 0) AS n_valid, state_avg,
    CASE WHEN coalesce(n_valid, 0) >= 3 AND amount < state_avg THEN 1 ELSE 0 END AS qualified
  FROM candidates LEFT JOIN valid_count ON candidates.row_id = valid_count.row_id
    LEFT JOIN threshold ON candidates.state = threshold.state),
cities AS (
  SELECT city, count(*) AS total_orders, CAST(sum(qualified) AS BIGINT) AS qualified_orders,
    round(sum(qualified) / count(*) * 100, 4) AS pct_cancelled
  FROM qualified WHERE city <> '' GROUP BY city)"""

# percentile_approx with 10,000 as accuracy is exact on groups of fewer orders
RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sku, "month" ORDER BY n_promos) AS row_num,
    count(*) OVER (PARTITION BY sku, "month") AS orders FROM prepared),
cuts AS (
  SELECT sku, "month", count(*) AS total_group_orders,
    max(CASE WHEN row_num = ceil(orders * CAST(0.9 AS DOUBLE)) THEN n_promos END) AS p90_thresh,
    max(CASE WHEN row_num = ceil(orders * CAST(0.8 AS DOUBLE)) THEN n_promos END) AS p80_thresh
  FROM ranked GROUP BY ALL),
above AS (
  SELECT prepared.sku, prepared."month",
    coalesce(stddev_pop(amount) FILTER (n_promos >= p90_thresh), 0.0) AS p90_stddev,
    coalesce(stddev_pop(amount) FILTER (n_promos >= p80_thresh), 0.0) AS p80_stddev
  FROM prepared JOIN cuts ON prepared.sku = cuts.sku AND prepared."month" = cuts."month"
  GROUP BY ALL),
groups_found AS (
  SELECT cuts.sku, cuts."month", p90_thresh, p80_thresh, total_group_orders, p90_stddev, p80_stddev
  FROM cuts JOIN above ON cuts.sku = above.sku AND cuts."month" = above."month")"""

PERCENTILES = f"""{SALES_LINE},
prepared AS (
  SELECT upper(trim(brand)) AS sku, strftime(order_date, '%Y-%m') AS month, n_promos, amount FROM sales_line
  WHERE trim(brand) <> '' AND order_date IS NOT NULL),
{RANKED.strip()}"""

# the price in cents in the place of the number of codes, years in the place of months
WIDE = f"""{SALES_LINE},
prepared AS (
  SELECT upper(trim(brand)) AS sku, strftime(order_date, '%Y-01') AS month, CAST(round(amount * 100) AS BIGINT) AS n_promos,
    amount FROM sales_line WHERE trim(brand) <> '' AND order_date IS NOT NULL),
{RANKED.strip()}"""

# the median and the P20 in the place of the approximate P90 and P80
LEVELS = f"""{PERCENTILES},
low_cuts AS (
  SELECT sku, "month",
    max(CASE WHEN row_num = ceil(orders * CAST(0.5 AS DOUBLE)) THEN n_promos END) AS p90_thresh_approx,
    max(CASE WHEN row_num = ceil(orders * CAST(0.2 AS DOUBLE)) THEN n_promos END) AS p80_thresh_approx
  FROM ranked GROUP BY ALL),
low_above AS (
  SELECT prepared.sku, prepared."month", p90_thresh_approx, p80_thresh_approx,
    coalesce(stddev_pop(amount) FILTER (n_promos >= p90_thresh_approx), 0.0) AS p90_stddev_approx,
    coalesce(stddev_pop(amount) FILTER (n_promos >= p80_thresh_approx), 0.0) AS p80_stddev_approx
  FROM prepared JOIN low_cuts ON prepared.sku = low_cuts.sku AND prepared."month" = low_cuts."month" GROUP BY ALL),
levels AS (
  SELECT groups_found.*, p90_thresh_approx, p80_thresh_approx, p90_stddev_approx, p80_stddev_approx,
    abs(p90_thresh_approx - p90_thresh) AS p90_thresh_diff, abs(p80_thresh_approx - p80_thresh) AS p80_thresh_diff,
    abs(p90_stddev_approx - p90_stddev) AS p90_stddev_diff, abs(p80_stddev_approx - p80_stddev) AS p80_stddev_diff
  FROM groups_found JOIN low_above
    ON groups_found.sku = low_above.sku AND groups_found."month" = low_above."month")"""


# a window is closed when its date is at or before the watermark, one day behind the last order
STREAM = """
event_order AS (
  SELECT event_type AS state, ts, CAST(ts AS DATE) AS order_date,
    CASE user_id % 11 WHEN 0 THEN 'Free' WHEN 1 THEN 'XS' WHEN 2 THEN 'S' WHEN 3 THEN 'M' WHEN 4 THEN 'L'
      WHEN 5 THEN 'XL' WHEN 6 THEN 'XXL' WHEN 7 THEN '3XL' WHEN 8 THEN '4XL' WHEN 9 THEN '5XL'
      ELSE '6XL' END AS size,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS qty
  FROM events),
volume AS (SELECT state, count(*) AS n_orders FROM event_order GROUP BY state),
lengths AS (
  SELECT state, CASE WHEN n_orders > (SELECT avg(n_orders) FROM volume) THEN 5 ELSE 10 END AS window_days FROM volume),
shipped AS (SELECT * FROM event_order WHERE qty > 0 AND state <> '' AND size <> ''),
totals AS (
  SELECT shipped.state, CAST(order_date + CAST(ahead AS INTEGER) AS DATE) AS window_date, size,
    count(*) AS n, CAST(sum(qty) AS BIGINT) AS sum_qty, CAST(sum(qty * qty) AS BIGINT) AS sum_qty_sq
  FROM shipped JOIN lengths ON shipped.state = lengths.state JOIN generate_series(1, 10) AS days(ahead)
    ON ahead <= window_days
  GROUP BY ALL)"""

# here the volume of a state is that of its orders with a quantity
OPEN_STREAM = STREAM.replace("FROM event_order GROUP BY state", "FROM event_order WHERE qty > 0 AND state <> '' GROUP BY state")


def _with(tables: str, select: str) -> str:
    return f"WITH {tables.strip()}\n{select}"


# a two-digit year means 20yy, and day 31 of February its last day
ORACLES: dict[str, str] = {
    "orders_from_csv": _with(SALES_ORDER, TYPED_ORDERS),
    "orders_from_records": _with(SALES_ORDER, TYPED_ORDERS),
    "orders_from_lines": _with(
        SALES_LINE,
        """SELECT CASE WHEN qty <> 13 THEN upper(state) END AS state,
  strftime(CASE WHEN size = 'Free' THEN make_date(2000 + year(order_date) % 100, 3, 1) - 1
    ELSE make_date(2000 + year(order_date) % 100, month(order_date), day(order_date)) END, '%Y-%m-%d') AS order_date,
  status, size, qty, CASE WHEN qty % 2 = 0 THEN CAST(qty AS INTEGER) ELSE 0 END AS whole_qty
FROM sales_line""",
    ),
    "line_fates": _with(
        SALES_LINE,
        """SELECT 'kept' AS fate, count(*) AS n_lines FROM sales_line UNION ALL SELECT 'header', 2 * count(*) FROM nation
UNION ALL SELECT 'blank', count(*) FROM nation UNION ALL SELECT 'short', count(*) FROM nation""",
    ),
    "clean_states": _with(STATES, "SELECT row_id, city, state FROM spelled WHERE state IS NOT NULL"),
    "state_fix_by_city": _with(STATES, "SELECT row_id, city, state FROM spelled"),
    "unmapped_states": _with(
        STATES,
        """SELECT state, count(*) AS n_rows FROM spelled
WHERE state IS NOT NULL AND state NOT IN (SELECT canon FROM state_alias) GROUP BY state""",
    ),
    "distinct_states": _with(STATES, "SELECT DISTINCT state FROM spelled WHERE state IS NOT NULL"),
    "clean_summary": _with(
        STATES,
        """SELECT count(*) AS rows_in, count(state) AS rows_out, count(*) - count(state) AS rows_removed,
  count(DISTINCT state) AS n_states FROM spelled""",
    ),
    "clean_counts": _with(
        STATES,
        "SELECT count(*) AS rows_in, count(state) AS rows_out, count(*) - count(state) AS rows_removed FROM spelled",
    ),
    "shipped_state_volume": _with(WINDOWS, "SELECT state, n_orders FROM volume"),
    "state_window_length": _with(WINDOWS, "SELECT state, window_days FROM lengths"),
    "window_input": _with(
        WINDOWS, "SELECT state, strftime(order_date, '%Y-%m-%d') AS order_date, size, qty FROM shipped"
    ),
    "window_triplets": _with(
        TOTALS,
        "SELECT state, strftime(window_date, '%Y-%m-%d') AS window_date, size, n, sum_qty, sum_qty_sq FROM totals",
    ),
    "window_size_variance": _with(
        TOTALS,
        """SELECT state, strftime(window_date, '%Y-%m-%d') AS window_date, size, n, round(variance, 6) AS variance
FROM measured""",
    ),
    "window_top_size": _with(TOTALS, TOP_SIZE),
    "window_two_loads": _with(TOTALS, TOP_SIZE),
    "sku_max_rank": _with(VARIETY, 'SELECT "month", state, style, sku, max_rank FROM skus'),
    "style_variety": _with(VARIETY, 'SELECT "month", state, style, variety, max_rank FROM styles'),
    "median_variety": _with(
        VARIETY, 'SELECT "month", state, median(variety) AS median_variety FROM styles GROUP BY "month", state'
    ),
    "normalized_orders": _with(
        SALES_ORDER,
        """SELECT row_id, strftime(order_date, '%Y-%m-%d') AS order_date, upper(trim(city)) AS city,
  upper(trim(state)) AS state, amount FROM sales_order""",
    ),
    "promo_lifespan": _with(
        PROMOS,
        """SELECT promo, strftime(first_d, '%Y-%m-%d') AS first_d, strftime(last_d, '%Y-%m-%d') AS last_d,
  n_tokens, CAST(active_days AS INTEGER) AS active_days FROM lifespan""",
    ),
    "valid_promos": _with(PROMOS, "SELECT promo FROM lifespan WHERE active_days >= 2"),
    "state_threshold": _with(PROMOS, "SELECT state, round(state_avg, 6) AS state_avg FROM threshold"),
    "cancelled_candidates": _with(PROMOS, "SELECT row_id, city, state, amount, promotion_ids FROM candidates"),
    "valid_promo_count": _with(PROMOS, "SELECT row_id, n_valid FROM valid_count"),
    "qualified_orders": _with(
        PROMOS,
        """SELECT row_id, city, state, amount, n_valid, round(state_avg, 6) AS state_avg, qualified
FROM qualified""",
    ),
    "city_cancel_pct": _with(PROMOS, "SELECT city, total_orders, qualified_orders, pct_cancelled FROM cities"),
    "city_totals": _with(
        PROMOS,
        """SELECT count(*) AS cities, CAST(sum(total_orders) AS BIGINT) AS total_orders,
  CAST(sum(qualified_orders) AS BIGINT) AS qualified_orders, max(qualified_orders) AS max_qualified FROM cities""",
    ),
    "promo_count": _with(
        SALES_ORDER,
        """SELECT row_id, CAST(coalesce(len(list_filter(string_split(promotion_ids, ','), lambda c: trim(c) <> '')), 0)
  AS INTEGER) AS n_promos FROM sales_order""",
    ),
    "prepared_sku_month": _with(PERCENTILES, 'SELECT sku, "month", n_promos, amount FROM prepared'),
    "pct_approx": _with(
        PERCENTILES,
        """SELECT sku, "month", p90_thresh AS p90_thresh_approx, p80_thresh AS p80_thresh_approx, total_group_orders
FROM groups_found""",
    ),
    "pct_exact": _with(
        PERCENTILES,
        """SELECT sku, "month", p90_thresh AS p90_thresh_exact, p80_thresh AS p80_thresh_exact FROM groups_found""",
    ),
    "pct_sketch_year": _with(
        PERCENTILES,
        """SELECT sku, CAST(substr("month", 1, 4) AS INTEGER) AS year, count(*) AS total_group_orders,
  quantile_disc(n_promos, 0.9) AS p90_thresh_approx, quantile_disc(n_promos, 0.8) AS p80_thresh_approx
FROM prepared GROUP BY ALL""",
    ),
    "pct_wide": _with(
        WIDE,
        """SELECT sku, "month", p90_thresh AS p90_thresh_exact, p80_thresh AS p80_thresh_exact,
  round(p90_stddev, 4) AS p90_stddev_exact, round(p80_stddev, 4) AS p80_stddev_exact FROM groups_found""",
    ),
    "stddev_above_approx": _with(
        PERCENTILES,
        """SELECT sku, "month", p90_thresh AS p90_thresh_approx, p80_thresh AS p80_thresh_approx, total_group_orders,
  round(p90_stddev, 4) AS p90_stddev_approx, round(p80_stddev, 4) AS p80_stddev_approx FROM groups_found""",
    ),
    "stddev_above_exact": _with(
        PERCENTILES,
        """SELECT sku, "month", p90_thresh AS p90_thresh_exact, p80_thresh AS p80_thresh_exact,
  round(p90_stddev, 4) AS p90_stddev_exact, round(p80_stddev, 4) AS p80_stddev_exact FROM groups_found""",
    ),
    "pct_compare": _with(
        PERCENTILES,
        """SELECT sku, "month", p90_thresh AS p90_thresh_approx, p80_thresh AS p80_thresh_approx, total_group_orders,
  round(p90_stddev, 4) AS p90_stddev_approx, round(p80_stddev, 4) AS p80_stddev_approx,
  p90_thresh AS p90_thresh_exact, p80_thresh AS p80_thresh_exact,
  round(p90_stddev, 4) AS p90_stddev_exact, round(p80_stddev, 4) AS p80_stddev_exact,
  0 AS p90_thresh_diff, 0 AS p80_thresh_diff,
  CAST(0 AS DOUBLE) AS p90_stddev_diff, CAST(0 AS DOUBLE) AS p80_stddev_diff FROM groups_found""",
    ),
    "pct_diff_report": _with(
        PERCENTILES,
        """SELECT count(*) AS n_groups, CAST(0 AS BIGINT) AS n_thresh_diff, CAST(0 AS BIGINT) AS n_stddev_diff,
  CAST(0 AS DOUBLE) AS pct_thresh_diff, CAST(0 AS DOUBLE) AS pct_stddev_diff FROM groups_found""",
    ),
    "pct_max_diff": _with(
        PERCENTILES,
        """SELECT max(p90_thresh - p90_thresh) AS max_p90_thresh_diff, max(p80_thresh - p80_thresh) AS max_p80_thresh_diff,
  max(p90_stddev - p90_stddev) AS max_p90_stddev_diff, max(p80_stddev - p80_stddev) AS max_p80_stddev_diff
FROM groups_found""",
    ),
    "pct_diff_levels": _with(
        LEVELS,
        """SELECT count(*) AS n_groups, count(*) FILTER (p90_thresh_diff > 1e-9) AS n_thresh_diff,
  count(*) FILTER (p90_stddev_diff > 1e-9) AS n_stddev_diff,
  round(count(*) FILTER (p90_thresh_diff > 1e-9) / count(*) * 100, 2) AS pct_thresh_diff,
  round(count(*) FILTER (p90_stddev_diff > 1e-9) / count(*) * 100, 2) AS pct_stddev_diff FROM levels""",
    ),
    "pct_max_diff_levels": _with(
        LEVELS,
        """SELECT max(p90_thresh_diff) AS max_p90_thresh_diff, max(p80_thresh_diff) AS max_p80_thresh_diff,
  round(max(p90_stddev_diff), 4) AS max_p90_stddev_diff, round(max(p80_stddev_diff), 4) AS max_p80_stddev_diff
FROM levels""",
    ),
    "pct_preview": _with(
        LEVELS,
        """SELECT sku, "month", p90_thresh_approx, p80_thresh_approx, total_group_orders,
  round(p90_stddev_approx, 4) AS p90_stddev_approx, round(p80_stddev_approx, 4) AS p80_stddev_approx,
  p90_thresh AS p90_thresh_exact, p80_thresh AS p80_thresh_exact,
  round(p90_stddev, 4) AS p90_stddev_exact, round(p80_stddev, 4) AS p80_stddev_exact,
  p90_thresh_diff, p80_thresh_diff,
  round(p90_stddev_diff, 4) AS p90_stddev_diff, round(p80_stddev_diff, 4) AS p80_stddev_diff
FROM levels ORDER BY sku, "month" LIMIT 20""",
    ),
    "stddev_nonzero": _with(
        PERCENTILES,
        """SELECT sku, "month", round(p90_stddev, 4) AS p90_stddev_exact FROM groups_found WHERE p90_stddev > 0""",
    ),
    "stddev_profile": _with(
        PERCENTILES,
        """SELECT count(*) AS n_groups, count(*) FILTER (p90_stddev > 0) AS n_nonzero_stddev FROM groups_found""",
    ),
    "stream_sliding_window": _with(
        STREAM,
        """SELECT state, strftime(window_date, '%Y-%m-%d') AS window_date, size, n, sum_qty, sum_qty_sq FROM totals
WHERE window_date <= (SELECT max(ts) - INTERVAL 1 DAY FROM shipped)""",
    ),
    "stream_open_windows": _with(
        OPEN_STREAM,
        """SELECT state, strftime(window_date, '%Y-%m-%d') AS window_date, size, n, CAST(sum_qty AS DOUBLE) AS sum_qty,
  CAST(sum_qty_sq AS DOUBLE) AS sum_qty_sq FROM totals""",
    ),
}
