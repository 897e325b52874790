"""The SQL equivalent of each registered query, over the raw tables only.

Written independently of the operators, in plain windows, joins and groupings.
"""

from __future__ import annotations

from rainledger.functions.conditions import DEFAULT_CONDITION, TOMORROW_CONDITIONS, WMO_CONDITIONS

SPLIT = "TIMESTAMP '2024-01-20 00:00:00'"
SPLIT_1998 = "TIMESTAMP '1998-01-01 00:00:00'"
DETAILS_SPLIT = "TIMESTAMP '2024-01-01 12:00:00'"
RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"
CHANGED = "TIMESTAMP '2024-01-21 00:00:00'"

WEATHER = """
b_weather AS (
  SELECT CAST(user_id % 5 AS INTEGER) AS city_id, 'CITY_' || CAST(user_id % 5 AS VARCHAR) AS city_name,
         CASE event_id % 3 WHEN 0 THEN 'openweather' WHEN 1 THEN 'openmeteo' ELSE 'tomorrowio' END AS source,
         ts AS fetched_at, value AS temperature, CAST(event_id % 100 AS INTEGER) AS humidity,
         CAST(user_id % 40 + 980 AS DOUBLE) AS pressure, (event_id % 30) / 4.0 AS wind_speed,
         event_type AS condition
  FROM events)"""

ORDERS = """
b_orders AS (
  SELECT o_orderkey AS order_id, c_nationkey AS store_id, o_custkey AS customer_id,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Delivery' ELSE 'Dine-in' END AS order_type,
         CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'Cancelled' END AS status,
         o_totalprice AS total_amount,
         TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 MINUTE * ((o_orderkey * 7919) % 43200) AS created_at
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def consensus(weather: str = "b_weather", name: str = "consensus") -> str:
    return f"""
{name}_votes AS (
  SELECT city_id, date_trunc('hour', fetched_at) AS date_hour, condition, count(*) AS n
  FROM {weather} WHERE fetched_at IS NOT NULL GROUP BY ALL),
{name}_major AS (
  SELECT city_id, date_hour, condition AS majority_condition FROM (
    SELECT *, row_number() OVER (PARTITION BY city_id, date_hour
                                 ORDER BY n DESC, condition ASC NULLS LAST) AS rn FROM {name}_votes)
  WHERE rn = 1),
{name}_stats AS (
  SELECT city_id, date_trunc('hour', fetched_at) AS date_hour, max(city_name) AS city_name,
         avg(temperature) AS avg_temperature, avg(humidity) AS avg_humidity, avg(pressure) AS avg_pressure,
         avg(wind_speed) AS avg_wind_speed, count(DISTINCT source) AS source_count,
         stddev_samp(temperature) AS temperature_stddev
  FROM {weather} WHERE fetched_at IS NOT NULL GROUP BY ALL),
{name} AS (
  SELECT s.city_id, CAST(s.date_hour AS TIMESTAMP) AS date_hour, s.city_name, s.avg_temperature, s.avg_humidity,
         s.avg_pressure, s.avg_wind_speed, m.majority_condition, s.source_count, s.temperature_stddev
  FROM {name}_stats s JOIN {name}_major m ON s.city_id = m.city_id AND s.date_hour = m.date_hour)"""


CONSENSUS_OUT = """
SELECT city_id, date_hour, city_name, round(avg_temperature, 9) AS avg_temperature,
       round(avg_humidity, 9) AS avg_humidity, round(avg_pressure, 9) AS avg_pressure,
       round(avg_wind_speed, 9) AS avg_wind_speed, majority_condition, source_count,
       round(temperature_stddev, 6) AS temperature_stddev
FROM consensus"""

ONE_VOTE = """
one_vote AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY city_id, date_trunc('hour', fetched_at), source
                                 ORDER BY fetched_at DESC) AS rn FROM b_weather) WHERE rn = 1)"""

STATIC_DIMS = """
dim_products AS (
  SELECT p_partkey AS product_id, p_type AS category, TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to FROM part),
dim_stores AS (
  SELECT n_nationkey AS store_id, n_regionkey AS city_id, TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to FROM nation)"""

def versioned_dims(reclassified: str, moved: str | None = None) -> str:
    """Products that change from type to brand and stores that move on, at the given times."""
    moved = moved or reclassified
    start = "TIMESTAMP '2024-01-01 00:00:00'"
    return f"""
dim_products AS (
  SELECT p_partkey AS product_id, p_type AS category, {start} AS valid_from, {reclassified} AS valid_to FROM part
  UNION ALL
  SELECT p_partkey, p_brand, {reclassified}, NULL FROM part),
dim_stores AS (
  SELECT n_nationkey AS store_id, n_regionkey AS city_id, {start} AS valid_from, {moved} AS valid_to FROM nation
  UNION ALL
  SELECT n_nationkey, CAST((n_regionkey + 1) % 5 AS INTEGER), {moved}, NULL FROM nation)"""


VERSIONED_DIMS = versioned_dims("TIMESTAMP '2024-01-16 00:00:00'", "TIMESTAMP '2024-01-11 00:00:00'")


def fact(dims: str = STATIC_DIMS, only_matched: bool = True) -> str:
    where = "WHERE w.majority_condition IS NOT NULL" if only_matched else ""
    return f"""
{WEATHER},{consensus()},{ORDERS},{dims},
fact AS (
  SELECT CAST(date_trunc('hour', o.created_at) AS TIMESTAMP) AS date_hour, CAST(o.created_at AS DATE) AS order_date,
         st.city_id, o.store_id, w.majority_condition AS weather_condition, w.avg_temperature AS temperature_c,
         o.order_type, p.category AS product_category, count(DISTINCT o.order_id) AS total_orders,
         CAST(sum(CAST(l.l_quantity AS INTEGER)) AS BIGINT) AS total_items_sold,
         CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
  FROM b_orders o
  JOIN lineitem l ON o.order_id = l.l_orderkey
  JOIN dim_products p ON l.l_partkey = p.product_id AND o.created_at >= p.valid_from
                     AND (p.valid_to IS NULL OR o.created_at < p.valid_to)
  JOIN dim_stores st ON o.store_id = st.store_id AND o.created_at >= st.valid_from
                    AND (st.valid_to IS NULL OR o.created_at < st.valid_to)
  LEFT JOIN consensus w ON st.city_id = w.city_id AND date_trunc('hour', o.created_at) = w.date_hour
  WHERE o.status <> 'Cancelled' {where.replace('WHERE', 'AND')}
  GROUP BY ALL)"""


FACT_OUT = """
SELECT date_hour, order_date, city_id, store_id, weather_condition, round(temperature_c, 9) AS temperature_c,
       order_type, product_category, total_orders, total_items_sold, total_revenue
FROM fact"""

STATS = f"""
{ORDERS},
stats AS (
  SELECT CAST(date_trunc('hour', created_at) AS TIMESTAMP) AS order_hour, CAST(created_at AS DATE) AS order_date,
         store_id, order_type, status, count(*) AS order_count,
         CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
         CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) / count(total_amount) AS avg_order_value
  FROM b_orders WHERE created_at IS NOT NULL GROUP BY ALL)"""

CDC = """
b_cdc AS (
  SELECT event_id AS uuid, ts AS source_timestamp,
         CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS change_type,
         CAST(user_id AS INTEGER) AS product_id, event_type AS category, value AS price,
         CAST(event_id % 2 AS INTEGER) AS is_active
  FROM events)"""

HISTORY = f"""
{CDC},
steps AS (
  SELECT *, lag(category) OVER (PARTITION BY product_id ORDER BY source_timestamp) AS prev_category
  FROM b_cdc WHERE change_type <> 'DELETE'),
history AS (
  SELECT product_id, category, source_timestamp AS valid_from,
         lead(source_timestamp) OVER (PARTITION BY product_id ORDER BY source_timestamp) AS valid_to
  FROM steps WHERE prev_category IS NULL OR prev_category <> category)"""


def scd2_two_batches(key: str, columns: dict[str, str], source: str, changed: str, prefix: str = "") -> str:
    """Latest row per key of each half, then the second half applied to the first."""
    halves, old_rows, new_rows, versions = (f"{prefix}{n}" for n in ("halves", "old_rows", "new_rows", "versions"))
    attrs = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    new = ", ".join(f"n.{name}" for name in columns)
    old = ", ".join(f"o.{name}" for name in columns)
    return f"""
{halves} AS (
  SELECT {attrs}, source_timestamp, source_timestamp > {SPLIT} AS second,
         row_number() OVER (PARTITION BY {columns[key]}, source_timestamp > {SPLIT}
                            ORDER BY source_timestamp DESC, uuid DESC) AS rn
  FROM {source} WHERE change_type <> 'DELETE'),
{old_rows} AS (SELECT * FROM {halves} WHERE rn = 1 AND NOT second),
{new_rows} AS (SELECT * FROM {halves} WHERE rn = 1 AND second),
{versions} AS (
  SELECT {old}, o.source_timestamp AS valid_from,
         CASE WHEN {changed} THEN n.source_timestamp END AS valid_to
  FROM {old_rows} o LEFT JOIN {new_rows} n ON o.{key} = n.{key}
  UNION ALL
  SELECT {new}, n.source_timestamp, NULL
  FROM {new_rows} n LEFT JOIN {old_rows} o ON o.{key} = n.{key}
  WHERE o.{key} IS NULL OR ({changed}))"""


GAPS = f"""
{CDC},
gaps AS (
  SELECT product_id, CASE WHEN uuid % 3 <> 0 THEN category END AS category, source_timestamp, uuid, change_type
  FROM b_cdc)"""


def category_batches(changed: str, added: str) -> str:
    """The two batches by the rules given: when the open version closes, and when the second batch opens one."""
    return f"""
halves AS (
  SELECT *, source_timestamp > {SPLIT} AS second,
         row_number() OVER (PARTITION BY product_id, source_timestamp > {SPLIT}
                            ORDER BY source_timestamp DESC, uuid DESC) AS rn
  FROM gaps WHERE change_type <> 'DELETE'),
o AS (SELECT * FROM halves WHERE rn = 1 AND NOT second),
n AS (SELECT * FROM halves WHERE rn = 1 AND second),
versions AS (
  SELECT o.product_id, o.category, o.source_timestamp AS valid_from,
         CASE WHEN {changed} THEN n.source_timestamp END AS valid_to
  FROM o LEFT JOIN n ON o.product_id = n.product_id
  UNION ALL
  SELECT n.product_id, n.category, n.source_timestamp, NULL
  FROM n LEFT JOIN o ON o.product_id = n.product_id WHERE {added})"""


# By match: NULL equals NULL only. By value: an open version without a category counts as none, and a
# change to no category goes unseen.
BY_MATCH = category_batches(
    "n.product_id IS NOT NULL AND n.category IS DISTINCT FROM o.category",
    "o.product_id IS NULL OR n.category IS DISTINCT FROM o.category",
)
BY_VALUE = category_batches("n.category <> o.category", "o.category IS NULL OR n.category <> o.category")

ROUGH = f"""
{CDC},
rough AS (
  SELECT user_id AS product_id, event_type AS category, ts AS valid_from,
         CASE WHEN event_id % 97 <> 0 THEN ts + INTERVAL 1 HOUR * (event_id % 7 - 2) END AS valid_to
  FROM events WHERE event_type <> 'error')"""

ASOF_UNMATCHED = f"""WITH {HISTORY}
SELECT p.product_id, p.source_timestamp AS happened_at, p.price AS amount
FROM b_cdc p WHERE p.change_type = 'DELETE' AND NOT EXISTS (
  SELECT 1 FROM history h WHERE p.product_id = h.product_id AND p.source_timestamp >= h.valid_from
    AND (h.valid_to IS NULL OR p.source_timestamp < h.valid_to))"""


def rough_asof(keys: int) -> str:
    return f"""WITH {ROUGH}
            SELECT CAST(f.product_id % {keys} AS INTEGER) AS product_id, r.category, count(*) AS matches
            FROM b_cdc f LEFT JOIN rough r ON f.product_id % {keys} = r.product_id % {keys}
                 AND f.source_timestamp >= r.valid_from AND (r.valid_to IS NULL OR f.source_timestamp < r.valid_to)
            WHERE f.change_type = 'DELETE' GROUP BY ALL"""


PRODUCT_COLUMNS = {"product_id": "product_id", "category": "category",
                   "price": "CAST(CAST(price AS DECIMAL(10,2)) AS DOUBLE)", "is_active": "is_active"}
PRODUCT_CHANGED = (
    "n.product_id IS NOT NULL AND (n.category <> o.category OR n.price <> o.price OR n.is_active <> o.is_active)"
)
PRODUCT_BATCHES = scd2_two_batches("product_id", PRODUCT_COLUMNS, "b_cdc", PRODUCT_CHANGED)
STORE_COLUMNS = {"store_id": "CAST(product_id % 50 AS INTEGER)", "city_id": "CAST(uuid % 3 AS INTEGER)",
                 "is_active": "is_active"}
STORE_CHANGED = "n.store_id IS NOT NULL AND (n.city_id <> o.city_id OR n.is_active <> o.is_active)"
STORE_BATCHES = scd2_two_batches("store_id", STORE_COLUMNS, "b_cdc", STORE_CHANGED)

SILVER_ORDERS = f"""
{ORDERS},
final AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, store_id, CAST(customer_id AS INTEGER) AS customer_id, order_type,
         status, CAST(CAST(total_amount AS DECIMAL(10,2)) AS DOUBLE) AS total_amount, created_at,
         created_at + INTERVAL 30 MINUTE AS updated_at
  FROM b_orders)"""


def silver_details(split: str) -> str:
    """Lines as first seen: the newest image of the first batch that holds the line."""
    return f"""
images AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS detail_id,
         CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS INTEGER) AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(CAST(l_tax AS DECIMAL(10,2)) AS DOUBLE) AS unit_price,
         CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS subtotal,
         TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 MINUTE * l_partkey AS seen_at,
         lpad(CAST(l_suppkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 12, '0')
           || '-' || CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS uuid
  FROM lineitem),
details AS (
  SELECT detail_id, order_id, product_id, quantity, unit_price, subtotal FROM (
    SELECT *, row_number() OVER (PARTITION BY detail_id
                                 ORDER BY seen_at > {split}, seen_at DESC, uuid DESC, order_id DESC, product_id DESC,
                                          quantity DESC, unit_price DESC, subtotal DESC) AS rn
    FROM images) WHERE rn = 1)"""


def code_case(names: dict[int, str]) -> str:
    """The lookup in a code table as CASE, in the table's own order."""
    branches = " ".join(f"WHEN {code} THEN '{name}'" for code, name in names.items())
    return f"CASE code {branches} ELSE '{DEFAULT_CONDITION}' END"


WMO, TOMORROW = code_case(WMO_CONDITIONS), code_case(TOMORROW_CONDITIONS)

BRONZE = """
b_bronze AS (
  SELECT CAST(user_id % 5 AS INTEGER) AS city_id, 'CITY_' || CAST(user_id % 5 AS VARCHAR) AS city_name,
         CASE event_id % 3 WHEN 0 THEN 'openweather' WHEN 1 THEN 'openmeteo' ELSE 'tomorrowio' END AS source,
         ts AS fetched_at,
         CASE event_id % 3
           WHEN 0 THEN '{"main":{"temp":' || value || ',"humidity":' || event_id % 100
                       || ',"pressure":1013},"wind":{"speed":3.5},"weather":'
                       || CASE WHEN event_id % 50 = 0 THEN '[]' ELSE '[{"main":"' || event_type || '"}]' END || '}'
           WHEN 1 THEN '{"current":{"temperature_2m":' || value || ',"relative_humidity_2m":' || event_id % 100
                       || ',"surface_pressure":1009.5,"wind_speed_10m":36.0,"weather_code":' || event_id % 100 || '}}'
           ELSE '{"data":{"values":{"temperature":' || value || ',"humidity":' || event_id % 100
                || '.9,"pressureSurfaceLevel":1008.25,"windSpeed":2.25,"weatherCode":' || 1000 * (event_id % 9) || '}}}'
         END AS raw_json
  FROM events)"""

SILVER_WEATHER = f"""
{BRONZE},
readings AS (
  SELECT city_id, city_name, source, fetched_at,
         TRY_CAST(json_extract_string(raw_json, CASE source WHEN 'openweather' THEN '$.main.temp'
           WHEN 'openmeteo' THEN '$.current.temperature_2m' ELSE '$.data.values.temperature' END) AS DOUBLE) AS temperature,
         CAST(trunc(TRY_CAST(json_extract_string(raw_json, CASE source WHEN 'openweather' THEN '$.main.humidity'
           WHEN 'openmeteo' THEN '$.current.relative_humidity_2m' ELSE '$.data.values.humidity' END) AS DOUBLE))
           AS INTEGER) AS humidity,
         TRY_CAST(json_extract_string(raw_json, CASE source WHEN 'openweather' THEN '$.main.pressure'
           WHEN 'openmeteo' THEN '$.current.surface_pressure' ELSE '$.data.values.pressureSurfaceLevel' END) AS DOUBLE)
           AS pressure,
         TRY_CAST(json_extract_string(raw_json, CASE source WHEN 'openweather' THEN '$.wind.speed'
           WHEN 'openmeteo' THEN '$.current.wind_speed_10m' ELSE '$.data.values.windSpeed' END) AS DOUBLE)
           / CASE source WHEN 'openmeteo' THEN CAST(3.6 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS wind_speed,
         json_extract_string(raw_json, '$.weather[0].main') AS text_condition,
         TRY_CAST(json_extract_string(raw_json, CASE source WHEN 'openmeteo' THEN '$.current.weather_code'
           ELSE '$.data.values.weatherCode' END) AS INTEGER) AS code
  FROM b_bronze),
silver_weather AS (
  SELECT city_id, city_name, source, fetched_at, temperature, humidity, pressure, wind_speed,
         CASE source WHEN 'openweather' THEN text_condition WHEN 'openmeteo' THEN {WMO} ELSE {TOMORROW} END AS condition,
         {RUN_TS} AS ingested_at
  FROM readings)"""

ORDER_EVENTS = f"""
b_order_events AS (
  SELECT user_id AS order_id, event_type AS status, value AS total_amount, event_id,
         CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 30 DAY ELSE ts END AS updated_at, ts AS source_timestamp
  FROM events),
halves AS (
  SELECT *, source_timestamp > {SPLIT} AS second,
         row_number() OVER (PARTITION BY order_id, source_timestamp > {SPLIT} ORDER BY source_timestamp DESC) AS rn
  FROM b_order_events),
t AS (SELECT * FROM halves WHERE rn = 1 AND NOT second),
s AS (SELECT * FROM halves WHERE rn = 1 AND second)"""


def oracle_sql() -> dict[str, str]:
    fact_cte = f"WITH {fact()}"
    weather_out = f"WITH {SILVER_WEATHER} SELECT * FROM silver_weather"
    scd2_out = "SELECT *, valid_to IS NULL AS is_current FROM versions"
    order_stats = f"WITH {STATS} SELECT * FROM stats"
    consensus_out = f"WITH {WEATHER},{consensus()} {CONSENSUS_OUT}"
    final_orders = f"WITH {SILVER_ORDERS} SELECT * FROM final"
    details_out = f"WITH {silver_details(DETAILS_SPLIT)} SELECT * FROM details"
    products = f"WITH {CDC},{PRODUCT_BATCHES} {scd2_out}"
    stores = f"WITH {CDC},{STORE_BATCHES} {scd2_out}"
    sql = {
        "weather_consensus": consensus_out,
        "weather_consensus_one_vote": f"WITH {WEATHER},{ONE_VOTE},{consensus('one_vote')} {CONSENSUS_OUT}",
        "condition_majority": f"""WITH {WEATHER},
            counted AS (SELECT city_id, source, condition, count(*) AS n FROM b_weather GROUP BY ALL)
            SELECT city_id, source, condition AS top_condition, n AS votes FROM (
              SELECT *, row_number() OVER (PARTITION BY city_id, source
                                           ORDER BY n DESC, condition NULLS LAST) AS rn FROM counted) WHERE rn = 1""",
        "realtime_order_stats": order_stats,
        "fact_sales_weather": f"{fact_cte} {FACT_OUT}",
        "fact_sales_weather_versioned": f"WITH {fact(VERSIONED_DIMS)} {FACT_OUT}",
        "fact_sales_weather_nested": f"WITH {fact(VERSIONED_DIMS)} {FACT_OUT}",
        "fact_sales_weather_unmatched": f"WITH {fact(only_matched=False)} {FACT_OUT}",
        "sales_without_weather": f"""WITH {WEATHER},{consensus()},{ORDERS}
            SELECT n_regionkey AS city_id, o.store_id, CAST(date_trunc('hour', created_at) AS TIMESTAMP) AS date_hour,
                   count(*) AS lost_orders
            FROM b_orders o JOIN nation ON n_nationkey = o.store_id
            LEFT JOIN consensus w ON w.city_id = n_regionkey AND w.date_hour = date_trunc('hour', created_at)
            WHERE o.status <> 'Cancelled' AND w.majority_condition IS NULL GROUP BY ALL""",
        "current_weather": f"""WITH {WEATHER},
            newest AS (SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY fetched_at DESC) AS rn FROM b_weather)
            SELECT r_regionkey AS city_id, r_name AS city_name,
                   CASE WHEN condition IS NULL OR condition = '' THEN 'Clouds' ELSE condition END AS condition,
                   CASE WHEN temperature IS NULL OR temperature = 0 THEN 25.0 ELSE temperature END AS temperature
            FROM newest JOIN region ON r_regionkey = city_id WHERE rn = 1""",
        "scd2_history": f"WITH {HISTORY} SELECT *, valid_to IS NULL AS is_current FROM history",
        "scd2_current": f"WITH {HISTORY} SELECT product_id, category, valid_from FROM history WHERE valid_to IS NULL",
        "scd2_apply_batch": f"WITH {GAPS},{BY_MATCH} {scd2_out}",
        "scd2_apply_batch_strict": f"WITH {GAPS},{BY_VALUE} {scd2_out}",
        "scd2_invariants": f"""WITH {HISTORY},
            opens AS (SELECT product_id, count(*) FILTER (valid_to IS NULL) AS n FROM history GROUP BY product_id),
            ends AS (SELECT *, max(coalesce(valid_to, TIMESTAMP '9999-12-31 00:00:00')) OVER (
                       PARTITION BY product_id ORDER BY valid_from, valid_to
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM history)
            SELECT 'several_open' AS rule, count(*) FILTER (n > 1) AS violations FROM opens
            UNION ALL SELECT 'no_open', count(*) FILTER (n = 0) FROM opens
            UNION ALL SELECT 'overlap', count(*) FILTER (reached > valid_from) FROM ends
            UNION ALL SELECT 'bad_interval', count(*) FILTER (valid_from IS NULL OR valid_to < valid_from) FROM ends""",
        "fact_asof_daily": f"""WITH {HISTORY}
            SELECT CAST(p.source_timestamp AS DATE) AS happened_on, h.category, count(*) AS incidents,
                   CAST(sum(CAST(p.price AS DECIMAL(18,2))) AS DOUBLE) AS amount
            FROM b_cdc p JOIN history h ON p.product_id = h.product_id AND p.source_timestamp >= h.valid_from
                 AND (h.valid_to IS NULL OR p.source_timestamp < h.valid_to)
            WHERE p.change_type = 'DELETE' GROUP BY ALL""",
        "asof_unmatched": ASOF_UNMATCHED,
        "asof_unmatched_nested": ASOF_UNMATCHED,
        "asof_overlapping": rough_asof(1000),
        "asof_overlapping_deep": rough_asof(3),
        "cdc_keep_latest": """SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                       l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
            FROM lineitem) WHERE rn = 1""",
        "cdc_keep_latest_rank": """SELECT * EXCLUDE (rk) FROM (
            SELECT *, rank() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC) AS rk
            FROM lineitem) WHERE rk = 1""",
        "cdc_incremental": f"SELECT * FROM events WHERE ts > {SPLIT}",
        "cdc_drop_deletes": f"WITH {CDC} SELECT * FROM b_cdc WHERE change_type <> 'DELETE'",
        "cdc_deleted_last": f"""WITH {CDC}
            SELECT product_id, source_timestamp FROM (
              SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY source_timestamp DESC) AS rn FROM b_cdc)
            WHERE rn = 1 AND change_type = 'DELETE'""",
        "merge_orders": f"""WITH {ORDER_EVENTS}
            SELECT t.order_id, CASE WHEN s.updated_at > t.updated_at THEN s.status ELSE t.status END AS status,
                   CASE WHEN s.updated_at > t.updated_at THEN s.total_amount ELSE t.total_amount END AS total_amount,
                   t.event_id, CASE WHEN s.updated_at > t.updated_at THEN s.updated_at ELSE t.updated_at END AS updated_at
            FROM t LEFT JOIN s ON t.order_id = s.order_id
            UNION ALL
            SELECT s.order_id, s.status, s.total_amount, s.event_id, s.updated_at
            FROM s LEFT JOIN t ON t.order_id = s.order_id WHERE t.order_id IS NULL""",
        "merge_insert_only": f"""SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate > {SPLIT_1998}, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                       l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
            FROM lineitem) WHERE rn = 1""",
        "decode_datetime": """SELECT event_id, CAST(ts AS DATE) AS day,
            epoch_us(ts) - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS micros, ts FROM events""",
        "silver_orders": final_orders,
        "silver_orders_deletes": f"{final_orders} WHERE store_id >= 5",
        "silver_order_details": details_out,
        "silver_products": products,
        "silver_products_deletes": f"""WITH {CDC},{PRODUCT_BATCHES},
            ranked AS (SELECT *, source_timestamp > {SPLIT} AS second,
                         row_number() OVER (PARTITION BY product_id, source_timestamp > {SPLIT}
                                            ORDER BY source_timestamp DESC) AS last_rn FROM b_cdc),
            ends AS (SELECT product_id, second, source_timestamp AS ended FROM ranked
                     WHERE last_rn = 1 AND change_type = 'DELETE'),
            first_end AS (SELECT product_id, ended FROM ends WHERE NOT second),
            second_end AS (SELECT product_id, ended FROM ends WHERE second),
            opened AS (
              SELECT o.*, e.ended FROM old_rows o LEFT JOIN first_end e ON o.product_id = e.product_id),
            applied AS (
              SELECT o.product_id, o.category, o.price, o.is_active, o.source_timestamp AS valid_from,
                     CASE WHEN o.ended IS NOT NULL THEN o.ended
                          WHEN n.product_id IS NOT NULL AND (n.category <> o.category OR n.price <> o.price
                               OR n.is_active <> o.is_active) THEN n.source_timestamp END AS valid_to
              FROM opened o LEFT JOIN new_rows n ON o.product_id = n.product_id
              UNION ALL
              SELECT n.product_id, n.category, n.price, n.is_active, n.source_timestamp, NULL
              FROM new_rows n LEFT JOIN opened o ON o.product_id = n.product_id
              WHERE o.product_id IS NULL OR o.ended IS NOT NULL OR n.category <> o.category
                 OR n.price <> o.price OR n.is_active <> o.is_active),
            closed AS (
              SELECT a.* EXCLUDE (valid_to), coalesce(a.valid_to, e.ended) AS valid_to
              FROM applied a LEFT JOIN second_end e ON a.product_id = e.product_id AND e.ended > a.valid_from)
            SELECT *, valid_to IS NULL AS is_current FROM closed""",
        "silver_stores": stores,
        "silver_weather": weather_out,
        "bronze_roundtrip": f"{weather_out} WHERE fetched_at > {SPLIT}",
        "active_dims": """
            SELECT 'products' AS dim, p_partkey AS id, p_type AS attribute FROM part WHERE p_size > 5
            UNION ALL SELECT 'stores', CAST(n_nationkey AS BIGINT), CAST(n_regionkey AS VARCHAR)
                      FROM nation WHERE n_regionkey < 4
            UNION ALL SELECT 'customers', c_custkey, CAST(c_custkey AS VARCHAR) FROM customer
            UNION ALL SELECT 'cities', CAST(r_regionkey AS BIGINT), r_name FROM region""",
        "published_consensus": consensus_out,
        "preview_fact": f"""{fact_cte} {FACT_OUT}
            ORDER BY total_revenue DESC, date_hour, order_type, product_category, store_id, city_id LIMIT 10""",
        "revenue_by_condition": f"""{fact_cte}
            SELECT weather_condition, product_category,
                   CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
                   CAST(sum(total_items_sold) AS BIGINT) AS items, CAST(sum(total_orders) AS BIGINT) AS order_count
            FROM fact GROUP BY ALL""",
        "delivery_ratio": f"""{fact_cte}
            SELECT weather_condition, CAST(hour(date_hour) AS INTEGER) AS hour_of_day,
                   CAST(sum(CASE WHEN order_type = 'Delivery' THEN total_orders ELSE 0 END) AS BIGINT) AS delivery_orders,
                   CAST(sum(total_orders) AS BIGINT) AS all_orders,
                   CAST(sum(CASE WHEN order_type = 'Delivery' THEN total_orders ELSE 0 END) AS DOUBLE)
                     / CAST(sum(total_orders) AS DOUBLE) AS delivery_share
            FROM fact GROUP BY ALL""",
        "hourly_volume": f"""WITH {STATS}
            SELECT order_hour, store_id, CAST(sum(order_count) AS BIGINT) AS order_count,
                   CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue, n_regionkey AS city_id
            FROM stats JOIN nation ON n_nationkey = store_id GROUP BY order_hour, store_id, n_regionkey""",
        "hourly_volume_versioned": f"""WITH {STATS},{VERSIONED_DIMS}
            SELECT s.order_hour, s.store_id, CAST(sum(order_count) AS BIGINT) AS order_count,
                   CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue, d.city_id
            FROM stats s LEFT JOIN dim_stores d ON d.store_id = s.store_id AND s.order_hour >= d.valid_from
                 AND (d.valid_to IS NULL OR s.order_hour < d.valid_to)
            GROUP BY s.order_hour, s.store_id, d.city_id""",
        "top_categories": f"""{fact_cte},
            revenue AS (SELECT weather_condition, product_category,
                          CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM fact GROUP BY ALL)
            SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY weather_condition
                             ORDER BY revenue DESC, product_category) AS INTEGER) AS rank FROM revenue)
            WHERE rank <= 3""",
        "status_scorecard": f"""WITH {STATS}
            SELECT status, CAST(sum(order_count) AS BIGINT) AS order_count,
                   CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue
            FROM stats GROUP BY status""",
        "not_null_gold": f"{fact_cte} " + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS violations FROM fact"
            for c in ("date_hour", "order_type", "product_category", "store_id", "city_id", "weather_condition",
                      "total_revenue")
        ),
        "unique_gold": f"""{fact_cte},
            groups AS (SELECT date_hour, order_type, product_category, store_id, city_id, count(*) AS n
                       FROM fact GROUP BY ALL)
            SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS group_count,
                   count(*) FILTER (n > 1) AS violations FROM groups""",
        "consensus_rules": f"""WITH {WEATHER},{consensus()}
            SELECT 'null city_id' AS rule, count(*) FILTER (city_id IS NULL) AS violations FROM consensus
            UNION ALL SELECT 'null date_hour', count(*) FILTER (date_hour IS NULL) FROM consensus
            UNION ALL SELECT 'repeated city_id, date_hour', count(*) - count(DISTINCT (city_id, date_hour)) FROM consensus""",
        "order_stats_rules": f"""WITH {STATS}
            SELECT 'null order_hour' AS rule, count(*) FILTER (order_hour IS NULL) AS violations FROM stats
            UNION ALL SELECT 'null order_count', count(*) FILTER (order_count IS NULL) FROM stats
            UNION ALL SELECT 'repeated order_hour, store_id, order_type, status',
                             count(*) - count(DISTINCT (order_hour, store_id, order_type, status)) FROM stats""",
        "cdc_read_batch": f"""WITH {ORDERS},
            steps AS (
              SELECT *, 'INSERT' AS change_type, created_at AS source_timestamp, 'Pending' AS step, 0.0 AS amount FROM b_orders
              UNION ALL SELECT *, 'UPDATE', created_at + INTERVAL 30 MINUTE, status, total_amount FROM b_orders
              UNION ALL SELECT *, 'DELETE', created_at + INTERVAL 60 MINUTE, status, total_amount FROM b_orders
                        WHERE store_id < 5)
            SELECT CAST(order_id AS VARCHAR) AS order_id, store_id, CAST(customer_id AS INTEGER) AS customer_id, order_type,
                   step AS status, CAST(CAST(amount AS DECIMAL(10,2)) AS DOUBLE) AS total_amount, created_at,
                   source_timestamp AS updated_at, source_timestamp, change_type
            FROM steps""",
        "table_append": f"WITH {WEATHER} SELECT *, {RUN_TS} AS ingested_at FROM b_weather",
        "materialized_order_stats": order_stats,
        "registered_sources": "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
        "ingest_stamp": f"WITH {BRONZE} SELECT source, count(*) AS row_count, true AS is_fresh FROM b_bronze GROUP BY source",
        "city_slugs": "SELECT n_name, replace(lower(n_name), ' ', '_') AS slug FROM nation",
        "envelope_json": """SELECT CAST(user_id % 5 AS BIGINT) AS city_id,
            strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS fetched_at,
            '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS raw_json FROM events""",
        "weather_route_counts": f"""WITH {BRONZE}, routed AS (
              SELECT CASE city_id WHEN 0 THEN 'weatherstation' WHEN 1 THEN NULL ELSE source END AS source FROM b_bronze)
            SELECT source, coalesce(source <> 'weatherstation', false) AS is_known, count(*) AS row_count
            FROM routed GROUP BY ALL""",
        "merge_orders_table_two_batches": final_orders,
        "merge_orders_moved_creation": final_orders,
        "order_details_many_batches": details_out,
        "stream_merge": final_orders,
        "stream_merge_deletes": f"{final_orders} WHERE store_id >= 5",
        "stream_order_stats": order_stats,
        "stream_order_details": details_out,
        "stream_products": products,
        "stream_stores": stores,
        "stream_weather": weather_out,
        "stream_weather_left_out": f"""WITH {BRONZE}
            SELECT 'unknown_source' AS reason, count(*) FILTER (city_id IN (0, 1)) AS row_count FROM b_bronze
            UNION ALL SELECT 'no_time', count(*) FILTER (city_id = 2) FROM b_bronze""",
        "stream_dedup": f"WITH {WEATHER} SELECT * FROM b_weather",
        "stream_consensus": consensus_out,
        "stream_consensus_late": consensus_out,
        "lakehouse_fact": f"""WITH {SILVER_WEATHER},{consensus("silver_weather")},{SILVER_ORDERS},
            {silver_details(SPLIT)},{versioned_dims(CHANGED)}
            SELECT CAST(date_trunc('hour', o.created_at) AS TIMESTAMP) AS date_hour,
                   CAST(o.created_at AS DATE) AS order_date, st.city_id, o.store_id,
                   w.majority_condition AS weather_condition, round(w.avg_temperature, 9) AS temperature_c,
                   o.order_type, p.category AS product_category, count(DISTINCT o.order_id) AS total_orders,
                   CAST(sum(d.quantity) AS BIGINT) AS total_items_sold,
                   CAST(sum(CAST(d.subtotal AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
            FROM final o
            JOIN details d ON o.order_id = d.order_id
            JOIN dim_products p ON d.product_id = p.product_id AND o.created_at >= p.valid_from
                             AND (p.valid_to IS NULL OR o.created_at < p.valid_to)
            JOIN dim_stores st ON o.store_id = st.store_id AND o.created_at >= st.valid_from
                              AND (st.valid_to IS NULL OR o.created_at < st.valid_to)
            JOIN consensus w ON st.city_id = w.city_id AND date_trunc('hour', o.created_at) = w.date_hour
            WHERE o.status <> 'Cancelled' AND w.majority_condition IS NOT NULL
            GROUP BY ALL""",
        "stream_enrich": f"""WITH {WEATHER},{consensus()},{ORDERS},{VERSIONED_DIMS}
            SELECT o.*, st.city_id, CAST(date_trunc('hour', o.created_at) AS TIMESTAMP) AS date_hour,
                   w.majority_condition AS weather_condition
            FROM b_orders o
            JOIN dim_stores st ON o.store_id = st.store_id AND o.created_at >= st.valid_from
                              AND (st.valid_to IS NULL OR o.created_at < st.valid_to)
            LEFT JOIN consensus w ON w.city_id = st.city_id AND w.date_hour = date_trunc('hour', o.created_at)""",
    }
    sql["stream_current_weather"] = sql["current_weather"]
    sql["lakehouse_current_weather"] = f"""WITH {SILVER_WEATHER},
            newest AS (SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY fetched_at DESC) AS rn FROM silver_weather)
            SELECT r_regionkey AS city_id, r_name AS city_name,
                   CASE WHEN condition IS NULL OR condition = '' THEN 'Clouds' ELSE condition END AS condition,
                   CASE WHEN temperature IS NULL OR temperature = 0 THEN 25.0 ELSE temperature END AS temperature
            FROM newest JOIN region ON r_regionkey = city_id WHERE rn = 1"""
    for source in ("openweather", "openmeteo", "tomorrowio"):
        sql[f"normalize_{source}"] = f"{weather_out} WHERE source = '{source}'"
    sql["stream_products_deletes"] = sql["silver_products_deletes"]
    return sql
