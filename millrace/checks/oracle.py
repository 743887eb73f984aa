"""SQL for another engine, written apart from the operators it checks.

Rounding is spelled out on the decimal text of a double, because engines differ
in how they round a binary value that lies at a half.
"""

from __future__ import annotations

from millrace.schema import QC_FLAGS, STATES, STATUSES

_STATE_LIST = ", ".join(f"'{s}'" for s in STATES)
_STATUS_LIST = ", ".join(f"'{s}'" for s in STATUSES)
_FLAGS = list(QC_FLAGS)


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def _round(x: str, digits: int = 2) -> str:
    return (f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)")


def _total(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(24,6))) AS DOUBLE)"


def _mean(x: str) -> str:
    return f"{_total(x)} / count({x})"


def _pct(part: str, whole: str, digits: int = 2) -> str:
    share = f"CAST({part} AS DOUBLE) / CAST(greatest({whole}, 1) AS DOUBLE) * 100.0"
    return _round(share, digits)


def _big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


_EV = f"""ev AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
    CASE WHEN l_partkey % 20 <> 0 THEN p_type END AS product_category,
    l_suppkey AS seller_id,
    CASE WHEN l_partkey % 83 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    p_retailprice AS unit_price, CAST(l_linenumber AS DOUBLE) * 2.5 AS freight_value,
    CASE WHEN l_partkey % 79 = 0 THEN -1.0 ELSE l_extendedprice END AS total_price,
    CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN 'bogus'
      WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
      ELSE 'created' END AS order_status,
    CASE WHEN l_partkey % 71 = 0 THEN 'XX'
      ELSE [{_STATE_LIST}][c_nationkey + 1] END AS customer_state,
    c_mktsegment AS customer_city, o_orderpriority AS payment_type,
    o_totalprice AS payment_value,
    CASE WHEN l_partkey % 73 <> 0 THEN o_orderdate + l_linenumber * INTERVAL 1 HOUR END AS event_ts,
    CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS order_delivered_ts,
    o_orderdate + INTERVAL 60 DAY AS order_estimated_ts,
    CAST(l_linenumber AS BIGINT) AS batch_id,
    CAST(1 + (l_linenumber * 3) % 7 AS BIGINT) AS shuffled_batch_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""

_CHECKED = _EV + f""", flagged AS (
  SELECT *, order_id IS NOT NULL AS qc_has_order_id,
    order_status IN ({_STATUS_LIST}) AS qc_valid_status,
    customer_state IN ({_STATE_LIST}) AS qc_valid_state,
    quantity > 0 AS qc_positive_qty, total_price > 0 AS qc_positive_price,
    event_ts IS NOT NULL AS qc_has_event_time
  FROM ev), judged AS (
  SELECT *, ({' AND '.join(_FLAGS)}) AS verdict FROM flagged), checked AS (
  SELECT *, coalesce(verdict, false) AS is_valid FROM judged)"""

_TIES = ", ".join(f"{c} ASC NULLS FIRST" for c in (
    "product_id", "seller_id", "freight_value", "total_price", "quantity", "order_delivered_ts"))
_NEWEST = f"event_ts DESC NULLS LAST, {_TIES}"

_SILVER = _CHECKED + f""", silver AS (
  SELECT * FROM checked WHERE is_valid
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {_NEWEST}) = 1)"""

_SILVER_PER_BATCH = _CHECKED + f""", silver_per_batch AS (
  SELECT * FROM checked WHERE is_valid
  QUALIFY row_number() OVER (PARTITION BY batch_id, order_id ORDER BY {_NEWEST}) = 1)"""


def _orders_log(commit: str = "shuffled_batch_id") -> str:
    return _CHECKED + f""", log AS (
  SELECT *, {commit} AS _commit_time FROM checked WHERE is_valid)"""


_USERS_LOG = """log AS (
  SELECT *, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS _commit_time FROM events)"""


def _latest_orders(where: str = "true") -> str:
    return f"""(SELECT * FROM log WHERE {where} QUALIFY row_number() OVER (
      PARTITION BY order_id
      ORDER BY event_ts DESC NULLS LAST, _commit_time DESC, {_TIES}) = 1)"""


def _latest_users(where: str = "true") -> str:
    return f"""(SELECT * FROM log WHERE {where} QUALIFY row_number() OVER (
      PARTITION BY user_id ORDER BY ts DESC, _commit_time DESC, event_id) = 1)"""


_EVENT_COLUMNS = f"""order_id, product_id, seller_id, {_big('quantity')} AS quantity,
  freight_value, total_price, order_status, customer_state, {_ts('event_ts')} AS event_ts"""
_ROW = f"""order_id, product_id, total_price, order_status,
  {_ts('event_ts')} AS event_ts, _commit_time"""
_USER_ROW = f"""user_id, event_id, {_ts('ts')} AS ts, event_type, value, _commit_time"""
_TEXT_FLAGS = ", ".join(f"CAST({f} AS VARCHAR) AS {f}" for f in _FLAGS)

ORACLE: dict[str, str] = {}

# --- quality --------------------------------------------------------------------------

ORACLE["qc_flags"] = f"""WITH {_CHECKED}
SELECT order_id, product_id, seller_id, freight_value, {_TEXT_FLAGS},
  CAST(is_valid AS VARCHAR) AS is_valid FROM checked"""

ORACLE["qc_three_valued_counts"] = f"""WITH {_CHECKED}
SELECT coalesce(CAST(verdict AS VARCHAR), 'unknown') AS verdict, count(*) AS records
FROM checked GROUP BY 1"""

ORACLE["quarantine_reasons"] = f"""WITH {_CHECKED}
SELECT {_TEXT_FLAGS}, count(*) AS records FROM checked WHERE NOT is_valid
GROUP BY {', '.join(_FLAGS)}"""

_BATCHES = _CHECKED + f""", counts AS (
  SELECT batch_id, count(*) AS total_records,
    count(*) FILTER (WHERE is_valid) AS valid_records,
    count(DISTINCT CASE WHEN is_valid THEN order_id END) AS silver_records
  FROM checked GROUP BY batch_id), batches AS (
  SELECT *, total_records - valid_records AS quarantine_records,
    valid_records - silver_records AS duplicates_removed,
    {_pct('valid_records', 'total_records')} AS valid_pct,
    {_pct('(total_records - valid_records)', 'total_records')} AS quarantine_pct,
    {_pct('(valid_records - silver_records)', 'valid_records')} AS dedup_pct
  FROM counts)"""

ORACLE["batch_quality_metrics"] = f"WITH {_BATCHES} SELECT * FROM batches"

_RUNNING = ", ".join(
    f"CAST(sum({source}) OVER (ORDER BY batch_id) AS BIGINT) AS {name}"
    for name, source in (
        ("cumulative_total", "total_records"), ("cumulative_valid", "valid_records"),
        ("cumulative_quarantine", "quarantine_records"),
        ("cumulative_silver", "silver_records"), ("cumulative_dedup", "duplicates_removed")))
_RUNNING += ", count(*) OVER (ORDER BY batch_id) AS cumulative_batches"

ORACLE["cumulative_quality_metrics"] = f"WITH {_BATCHES} SELECT batch_id, {_RUNNING} FROM batches"

ORACLE["metrics_json_scan"] = f"""WITH {_BATCHES}
SELECT CAST(batch_id AS VARCHAR) AS batch_id, CAST(total_records AS VARCHAR) AS total_records,
  CAST(valid_records AS VARCHAR) AS valid_records,
  CAST(quarantine_records AS VARCHAR) AS quarantine_records,
  CASE WHEN batch_id % 2 = 1 THEN CAST(silver_records AS VARCHAR) END AS silver_records,
  CASE WHEN batch_id % 2 <> 1 THEN CAST(silver_records AS VARCHAR) END AS silver_upserted,
  CAST(duplicates_removed AS VARCHAR) AS duplicates_removed FROM batches"""

ORACLE["metrics_typed"] = f"""WITH {_BATCHES}
SELECT *, total_records / 1000.0::DOUBLE AS batch_duration_sec FROM batches"""

ORACLE["quality_summary"] = f"""WITH {_BATCHES}
SELECT CAST(sum(total_records) AS BIGINT) AS total_records,
  CAST(sum(valid_records) AS BIGINT) AS valid_records,
  CAST(sum(quarantine_records) AS BIGINT) AS quarantine_records,
  CAST(sum(silver_records) AS BIGINT) AS silver_records,
  CAST(sum(duplicates_removed) AS BIGINT) AS duplicates_removed,
  {_mean('valid_pct')} AS avg_valid_pct, {_mean('quarantine_pct')} AS avg_quarantine_pct,
  {_mean('dedup_pct')} AS avg_dedup_pct,
  {_mean('(total_records / 1000.0::DOUBLE)')} AS avg_batch_duration_sec,
  max(total_records / 1000.0::DOUBLE) AS max_batch_duration_sec,
  count(*) AS batch_count FROM batches"""

# --- layers ---------------------------------------------------------------------------

ORACLE["bronze_layer"] = f"""WITH {_CHECKED}
SELECT {_EVENT_COLUMNS}, CAST(is_valid AS VARCHAR) AS is_valid FROM checked"""

ORACLE["quarantine_layer"] = f"""WITH {_CHECKED}
SELECT {_EVENT_COLUMNS}, {_TEXT_FLAGS} FROM checked WHERE NOT is_valid"""

ORACLE["silver_layer_batch_dedup"] = f"""WITH {_SILVER_PER_BATCH}
SELECT batch_id, {_EVENT_COLUMNS} FROM silver_per_batch"""

ORACLE["layer_scan_parquet"] = f"""WITH {_EV}
SELECT customer_state, count(*) AS records, {_total('total_price')} AS amount
FROM ev GROUP BY customer_state"""

ORACLE["layer_counts"] = f"""WITH {_SILVER}, per_batch AS (
  SELECT DISTINCT batch_id, order_id FROM checked WHERE is_valid)
SELECT 'bronze' AS layer, count(*) AS records FROM ev
UNION ALL SELECT 'silver_append', count(*) FROM per_batch
UNION ALL SELECT 'silver_versions', count(*) FROM silver
UNION ALL SELECT 'quarantine', count(*) FROM checked WHERE NOT is_valid"""

ORACLE["dedup_latest_per_key"] = f"""WITH {_EV}, newest AS (
  SELECT * FROM ev WHERE event_ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {_NEWEST}) = 1)
SELECT {_EVENT_COLUMNS} FROM newest"""

ORACLE["latest_silver_sample"] = f"""WITH {_SILVER}, sample AS (
  SELECT * FROM silver ORDER BY event_ts DESC NULLS LAST, order_id LIMIT 10)
SELECT order_id, order_status, customer_state, total_price, payment_type,
  {_ts('event_ts')} AS event_ts FROM sample"""

# --- versioned table ------------------------------------------------------------------

ORACLE["snapshot_latest"] = f"WITH {_USERS_LOG} SELECT {_USER_ROW} FROM {_latest_users()}"

ORACLE["time_travel_as_of"] = f"""WITH {_USERS_LOG}
SELECT {_USER_ROW} FROM {_latest_users('_commit_time <= 20240115')}"""

ORACLE["incremental_since"] = f"""WITH {_USERS_LOG}
SELECT {_USER_ROW} FROM {_latest_users()} WHERE _commit_time > 20240128"""

ORACLE["incremental_between"] = f"""WITH {_orders_log()}
SELECT {_ROW} FROM {_latest_orders('_commit_time <= 5')} WHERE _commit_time > 2"""

# State at the end of every pair of successive surviving commits, in full.
ORACLE["incremental_per_commit"] = f"""WITH {_orders_log()}, surviving AS (
  SELECT DISTINCT _commit_time AS c FROM {_latest_orders()}), pairs AS (
  SELECT lag(c) OVER (ORDER BY c) AS begin_commit, c AS end_commit FROM surviving),
states AS (
  SELECT begin_commit, end_commit, log.* FROM pairs JOIN log ON _commit_time <= end_commit
  WHERE begin_commit IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY end_commit, order_id
    ORDER BY event_ts DESC NULLS LAST, _commit_time DESC, {_TIES}) = 1)
SELECT begin_commit, end_commit, count(*) AS records FROM states
WHERE _commit_time > begin_commit GROUP BY begin_commit, end_commit"""

ORACLE["incremental_reduction"] = f"""WITH {_USERS_LOG}, snap AS (
  SELECT * FROM {_latest_users()}), counts AS (
  SELECT count(*) AS full_records, count(*) FILTER (
    WHERE _commit_time > (SELECT min(_commit_time) FROM snap)) AS incremental_records FROM snap)
SELECT *, {_pct('(full_records - incremental_records)', 'full_records', 1)} AS reduction_pct
FROM counts"""

ORACLE["upsert_latest_wins"] = f"""WITH {_orders_log('batch_id')}
SELECT {_ROW} FROM {_latest_orders()}"""
ORACLE["upsert_late_event_ignored"] = f"""WITH {_orders_log()}
SELECT {_ROW} FROM {_latest_orders()}"""
ORACLE["upsert_bucketed_base"] = ORACLE["upsert_late_event_ignored"]
ORACLE["stored_table_with_base"] = ORACLE["upsert_late_event_ignored"]

ORACLE["commit_timeline"] = f"""WITH {_orders_log()}
SELECT _commit_time, count(*) AS records FROM {_latest_orders()} GROUP BY _commit_time"""
ORACLE["commit_timeline_log"] = f"""WITH {_orders_log()}
SELECT _commit_time, count(*) AS records FROM log GROUP BY _commit_time"""

ORACLE["time_travel_status_distribution"] = f"""WITH {_orders_log()}
SELECT order_status, count(*) AS records FROM {_latest_orders('_commit_time <= 3')}
GROUP BY order_status"""

ORACLE["time_travel_growth"] = f"""WITH {_orders_log()}, bounds AS (
  SELECT min(_commit_time) AS early_commit, max(_commit_time) AS late_commit
  FROM {_latest_orders()}), sizes AS (
  SELECT early_commit, late_commit,
    count(DISTINCT CASE WHEN _commit_time <= early_commit THEN order_id END) AS early_records,
    count(DISTINCT CASE WHEN _commit_time <= late_commit THEN order_id END) AS late_records
  FROM log, bounds GROUP BY ALL)
SELECT *, late_records - early_records AS growth FROM sizes"""

ORACLE["upsert_audit"] = f"""WITH {_SILVER}, audits AS (
  SELECT 'bronze' AS layer, count(*) AS total_rows, count(DISTINCT order_id) AS unique_keys FROM ev
  UNION ALL SELECT 'silver', count(*), count(DISTINCT order_id) FROM silver)
SELECT *, total_rows - unique_keys AS duplicate_rows,
  {_pct('(total_rows - unique_keys)', 'total_rows')} AS duplicate_pct FROM audits"""

ORACLE["multi_version_orders"] = f"""WITH {_EV}
SELECT order_id, count(*) AS versions FROM ev GROUP BY order_id HAVING count(*) > 1"""
ORACLE["most_updated_order"] = ORACLE["multi_version_orders"] + """
ORDER BY versions DESC, order_id LIMIT 1"""

ORACLE["order_version_history"] = f"""WITH {_orders_log()}, numbered AS (
  SELECT *, count(*) OVER (PARTITION BY order_id) AS versions FROM log)
SELECT n.order_id, n.order_status, {_ts('n.event_ts')} AS event_ts, n.product_id, n.total_price,
  w.order_status AS current_order_status, {_ts('w.event_ts')} AS current_event_ts,
  w.product_id AS current_product_id, w.total_price AS current_total_price, versions
FROM numbered n JOIN {_latest_orders()} w ON n.order_id = w.order_id WHERE versions > 1"""

ORACLE["table_stats"] = f"""WITH {_orders_log()}
SELECT count(*) AS total_rows, count(DISTINCT customer_state) AS partitions,
  count(DISTINCT _commit_time) AS commits, max(_commit_time) AS latest_commit
FROM {_latest_orders()}"""

ORACLE["partition_row_counts"] = f"""WITH {_SILVER}
SELECT customer_state, count(*) AS records FROM silver GROUP BY customer_state
ORDER BY records DESC, customer_state LIMIT 15"""

ORACLE["history_retention"] = f"""WITH {_orders_log()}, cut AS (
  SELECT min(c) AS oldest FROM (
    SELECT DISTINCT _commit_time AS c FROM log ORDER BY c DESC LIMIT 3))
SELECT {_ROW} FROM {_latest_orders('_commit_time <= (SELECT oldest FROM cut)')}
UNION ALL SELECT {_ROW} FROM log WHERE _commit_time > (SELECT oldest FROM cut)"""

ORACLE["layout_rewrite_preserves_rows"] = f"""WITH {_EV}
SELECT {_EVENT_COLUMNS} FROM ev"""

# --- schema evolution -----------------------------------------------------------------

_EVOLVED = _orders_log() + f""", before AS (SELECT * FROM {_latest_orders()}), evolved AS (
  SELECT * REPLACE (CASE WHEN changed THEN 8 ELSE _commit_time END AS _commit_time),
    CASE WHEN changed THEN CAST(order_id % 5 + 1 AS BIGINT) END AS review_score,
    CASE WHEN changed THEN CAST(date_diff('day', CAST(order_estimated_ts AS DATE),
      CAST(order_delivered_ts AS DATE)) AS DOUBLE) END AS delivery_delay_days
  FROM (SELECT *, order_status = 'delivered' AS changed FROM before))"""

ORACLE["evolve_schema"] = f"""WITH {_EVOLVED}
SELECT {_ROW}, review_score, delivery_delay_days FROM evolved"""

ORACLE["evolution_null_audit"] = f"""WITH {_EVOLVED}
SELECT 'review_score' AS column_name, count(review_score) AS not_null_records,
  count(*) - count(review_score) AS null_records FROM evolved
UNION ALL SELECT 'delivery_delay_days', count(delivery_delay_days),
  count(*) - count(delivery_delay_days) FROM evolved"""

ORACLE["evolution_sample"] = f"""WITH {_orders_log()}, sample AS (
  SELECT * FROM {_latest_orders()} WHERE order_status = 'delivered' ORDER BY order_id LIMIT 100)
SELECT order_id, order_status, CAST(order_id % 5 + 1 AS BIGINT) AS review_score,
  CAST(date_diff('day', CAST(order_estimated_ts AS DATE), CAST(order_delivered_ts AS DATE))
    AS DOUBLE) AS delivery_delay_days FROM sample"""

_SCHEMA_ROWS = (
    ("order_id", "bigint", "false"), ("quantity", "int", "false"),
    ("total_price", "double", "false"), ("order_status", "string", "false"),
    ("event_ts", "timestamp_ntz", "false"), ("review_score", "int", "true"),
    ("delivery_delay_days", "double", "true"))
ORACLE["schema_diff"] = f"WITH {_EVOLVED} " + " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, '{kind}' AS data_type, '{new}' AS is_new,"
    f" count({name}) AS not_null_records FROM evolved" for name, kind, new in _SCHEMA_ROWS)

# --- gold and analytics ---------------------------------------------------------------

_MEASURES = f"""{_total('total_price')} AS total_revenue,
  count(DISTINCT order_id) AS order_count, {_mean('total_price')} AS avg_order_value"""
_DELAY = "CAST(epoch(order_delivered_ts) - epoch(order_estimated_ts) AS BIGINT)"

_GOLD_DAILY = f"""gold_daily AS (
  SELECT CAST(event_ts AS DATE) AS order_date, {_MEASURES},
    {_total('freight_value')} AS total_freight, {_mean('freight_value')} AS avg_freight
  FROM silver GROUP BY 1)"""
_GOLD_STATE = f"""gold_state_raw AS (
  SELECT customer_state, {_MEASURES},
    CAST(sum({_DELAY}) AS DOUBLE) / 3600.0::DOUBLE / count({_DELAY}) AS avg_delivery_delay_hrs,
    count(*) FILTER (WHERE {_DELAY} > 0) AS late_deliveries, count(*) AS total_records
  FROM silver GROUP BY customer_state), gold_state AS (
  SELECT *, {_pct('late_deliveries', 'total_records')} AS late_delivery_pct FROM gold_state_raw)"""
_GOLD_STATUS = f"""gold_status AS (
  SELECT order_status, {_MEASURES} FROM silver GROUP BY order_status)"""
_GOLD_CATEGORY = f"""gold_category AS (
  SELECT *, dense_rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank FROM (
    SELECT product_category, {_MEASURES}, CAST(sum(quantity) AS BIGINT) AS total_qty,
      {_mean('unit_price')} AS avg_unit_price
    FROM silver WHERE product_category IS NOT NULL GROUP BY product_category))"""

ORACLE["gold_daily_revenue"] = f"""WITH {_SILVER}, {_GOLD_DAILY}
SELECT * REPLACE (strftime(order_date, '%Y-%m-%d') AS order_date),
  {_round('total_revenue / order_count')} AS revenue_per_order,
  strftime(order_date, '%Y%m%d') AS date_key FROM gold_daily"""
ORACLE["gold_state_metrics"] = f"WITH {_SILVER}, {_GOLD_STATE} SELECT * FROM gold_state"
ORACLE["gold_status_funnel"] = f"WITH {_SILVER}, {_GOLD_STATUS} SELECT * FROM gold_status"
ORACLE["gold_category_performance"] = f"""WITH {_SILVER}, {_GOLD_CATEGORY}
SELECT * FROM gold_category"""
ORACLE["gold_full_refresh"] = ORACLE["gold_state_metrics"]

ORACLE["gold_upsert"] = f"""WITH {_orders_log()}, early AS (
  SELECT order_status, {_MEASURES} FROM {_latest_orders('_commit_time <= 4')}
  GROUP BY order_status), now AS (
  SELECT order_status, {_MEASURES} FROM {_latest_orders()}
  WHERE order_status <> 'created' GROUP BY order_status)
SELECT * FROM now
UNION ALL SELECT * FROM early WHERE order_status NOT IN (SELECT order_status FROM now)"""

ORACLE["daily_revenue_trend"] = f"""WITH {_SILVER}, {_GOLD_DAILY}, moving AS (
  SELECT *, CAST(sum(CAST(total_revenue AS DECIMAL(24,6))) OVER seven AS DOUBLE)
    / count(*) OVER seven AS ma FROM gold_daily
  WINDOW seven AS (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT strftime(order_date, '%Y-%m-%d') AS order_date, {_round('total_revenue')} AS revenue,
  order_count, {_round('avg_order_value')} AS aov, {_round('ma')} AS revenue_7d_ma FROM moving"""

ORACLE["top_states_revenue"] = f"""WITH {_SILVER}, {_GOLD_STATE}, top AS (
  SELECT * FROM gold_state ORDER BY total_revenue DESC, customer_state LIMIT 10)
SELECT customer_state, {_round('total_revenue')} AS revenue, order_count,
  {_round('avg_order_value')} AS aov, {_round('avg_delivery_delay_hrs', 1)} AS avg_delay_hrs,
  late_deliveries, {_round('late_delivery_pct', 1)} AS late_pct FROM top"""


def _share(part: str, whole: str) -> str:
    return _round(f"CAST({part} AS DOUBLE) * 100.0::DOUBLE / CAST({whole} AS DOUBLE)", 1)


ORACLE["status_funnel_pct"] = f"""WITH {_SILVER}, {_GOLD_STATUS}, whole AS (
  SELECT *, sum(order_count) OVER () AS all_orders FROM gold_status)
SELECT order_status, order_count, {_round('total_revenue')} AS revenue,
  {_round('avg_order_value')} AS aov, {_share('order_count', 'all_orders')} AS pct_of_total
FROM whole"""

ORACLE["top_categories"] = f"""WITH {_SILVER}, {_GOLD_CATEGORY}
SELECT product_category, revenue_rank, {_round('total_revenue')} AS revenue, total_qty,
  order_count, {_round('avg_unit_price')} AS avg_price FROM gold_category
WHERE revenue_rank <= 20"""

_PAYMENT = f"""by_type AS (
  SELECT payment_type, count(DISTINCT order_id) AS order_count, {_total('total_price')} AS revenue,
    {_mean('total_price')} AS aov, (SELECT {_total('total_price')} FROM silver) AS everything
  FROM silver GROUP BY payment_type)"""
ORACLE["payment_method_breakdown"] = f"""WITH {_SILVER}, {_PAYMENT}
SELECT payment_type, order_count, {_round('revenue')} AS total_revenue,
  {_round('aov')} AS avg_order_value, {_share('revenue', 'everything')} AS revenue_pct
FROM by_type"""
ORACLE["catalog_report"] = ORACLE["payment_method_breakdown"]

ORACLE["hourly_distribution"] = f"""WITH {_SILVER}, hours AS (
  SELECT hour(event_ts) AS order_hour, count(DISTINCT order_id) AS order_count,
    {_total('total_price')} AS revenue, {_mean('total_price')} AS aov FROM silver GROUP BY 1)
SELECT order_hour, order_count, {_round('revenue')} AS total_revenue,
  {_round('aov')} AS avg_order_value FROM hours"""

ORACLE["customer_concentration"] = f"""WITH {_SILVER}, {_GOLD_STATE}, running AS (
  SELECT *, sum(order_count) OVER (ORDER BY order_count DESC) AS so_far,
    sum(order_count) OVER () AS all_orders FROM gold_state)
SELECT customer_state, order_count, {_round('total_revenue')} AS revenue,
  {_share('so_far', 'all_orders')} AS cumulative_pct FROM running"""

ORACLE["delivery_sla"] = f"""WITH {_SILVER}, {_GOLD_STATE}
SELECT customer_state, total_records AS total_orders, late_deliveries,
  total_records - late_deliveries AS on_time,
  {_share('(total_records - late_deliveries)', 'total_records')} AS on_time_pct,
  {_round('avg_delivery_delay_hrs', 1)} AS avg_delay_hrs FROM gold_state"""

ORACLE["catalog_tables"] = f"""WITH {_SILVER}
SELECT 'orders_silver' AS table_name, count(*) AS records FROM silver
UNION ALL SELECT 'gold_daily_revenue', count(DISTINCT CAST(event_ts AS DATE)) FROM silver
UNION ALL SELECT 'gold_state_metrics', count(DISTINCT customer_state) FROM silver
UNION ALL SELECT 'gold_status_funnel', count(DISTINCT order_status) FROM silver
UNION ALL SELECT 'gold_category_performance', count(DISTINCT product_category) FROM silver"""

# --- shop tables to events ------------------------------------------------------------

def _payments(paid: str) -> str:
    return f"""payments AS (
  SELECT o_orderkey AS order_id, 1 AS seq, o_orderpriority AS payment_type,
    o_totalprice AS payment_value FROM orders WHERE {paid}
  UNION ALL SELECT o_orderkey, 2, 'voucher', 10.0 FROM orders
  WHERE {paid} AND o_orderkey % 2 = 0), paid AS (
  SELECT order_id, CAST(sum(CAST(payment_value AS DECIMAL(24,6))) AS DOUBLE) AS payment_value,
    arg_min(payment_type, seq) AS payment_type FROM payments GROUP BY order_id)"""


ORACLE["payments_per_order"] = f"WITH {_payments('true')} SELECT * FROM paid"

ORACLE["enriched_order_events"] = f"""WITH {_payments('o_orderkey % 10 <> 0')}
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
  coalesce(p_type, 'unknown') AS product_category, CAST(l_suppkey AS VARCHAR) AS seller_id,
  1::BIGINT AS quantity, {_round('l_extendedprice')} AS unit_price,
  {_round('(l_linenumber * 2.5::DOUBLE)')} AS freight_value,
  {_round('(l_extendedprice + l_linenumber * 2.5::DOUBLE)')} AS total_price,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'confirmed'
    ELSE 'cancelled' END AS order_status,
  CASE WHEN c_custkey IS NULL THEN 'unknown'
    ELSE [{_STATE_LIST}][c_nationkey + 1] END AS customer_state,
  coalesce(c_mktsegment, 'unknown') AS customer_city,
  coalesce(payment_type, 'unknown') AS payment_type,
  {_round('coalesce(payment_value, 0.0::DOUBLE)')} AS payment_value,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS event_time,
  CAST(NULL AS VARCHAR) AS order_delivered_ts,
  strftime(o_orderdate + INTERVAL 60 DAY, '%Y-%m-%d %H:%M:%S') AS order_estimated_ts
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 40 <> 0) ON o_custkey = c_custkey
LEFT JOIN (SELECT * FROM part WHERE p_partkey % 50 <> 0) ON l_partkey = p_partkey
LEFT JOIN paid ON paid.order_id = o_orderkey
WHERE o_orderkey % 61 <> 0"""

# Repeats follow the rows they repeat and win.
ORACLE["enriched_order_events_repeats"] = ORACLE["enriched_order_events"].replace(
    "coalesce(c_mktsegment, 'unknown')",
    "CASE WHEN c_custkey % 3 = 0 THEN 'moved' ELSE coalesce(c_mktsegment, 'unknown') END"
).replace(
    "coalesce(p_type, 'unknown')",
    "CASE WHEN p_partkey % 3 = 0 THEN 'renamed' ELSE coalesce(p_type, 'unknown') END")

ORACLE["money_sums_wide"] = """WITH amounts AS (
  SELECT l_linenumber AS line, l_extendedprice * 1e15 AS wide, l_quantity AS narrow,
    l_partkey % 50 = 0 AS spoilt FROM lineitem)
SELECT CAST(line AS BIGINT) AS line,
  CAST(CAST(sum(CAST(wide AS DECIMAL(38,0))) AS VARCHAR) AS DOUBLE) AS wide_total,
  CAST(sum(CAST(CASE WHEN NOT spoilt THEN narrow END AS DECIMAL(24,6))) AS DOUBLE) AS finite_total,
  CAST(count(*) FILTER (WHERE spoilt) AS BIGINT) AS not_finite,
  CAST(count(*) FILTER (WHERE spoilt) > 0 AS VARCHAR) AS spoilt_total_is_nan
FROM amounts GROUP BY line"""

ORACLE["upsert_equal_time_and_commit"] = f"""WITH {_orders_log()}, base AS (
  SELECT * FROM {_latest_orders('_commit_time <= 4')})
SELECT {_ROW}, CASE WHEN order_id % 2 = 1 THEN seller_id - 1 ELSE seller_id END AS seller_id FROM base"""

ORACLE["stream_watermark_dedup"] = """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS order_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey"""

ORACLE["stream_late_side_output"] = f"""WITH {_EV}, sent AS (
  SELECT order_id, (shuffled_batch_id - 1) // 3 AS arrival, 60 * arrival
    - CASE WHEN arrival > 0 AND order_id % 5 = 0 THEN 10800 ELSE 0 END AS sent_at FROM ev), marks AS (
  SELECT arrival, max(max(sent_at)) OVER (ORDER BY arrival
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3600 AS mark FROM sent GROUP BY arrival),
told AS (SELECT order_id, coalesce(sent_at <= mark, false) AS is_late FROM sent JOIN marks USING (arrival))
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(is_late AS VARCHAR) AS is_late,
  CASE WHEN is_late THEN count(*) ELSE 1 END AS messages FROM told GROUP BY order_id, is_late"""

ORACLE["normalize_status"] = """WITH raw AS (
  SELECT ['created', 'approved', 'invoiced', 'processing', 'shipped', 'delivered',
    'unavailable', 'canceled', 'lost'][o_orderkey % 9 + 1] AS raw_status FROM orders)
SELECT raw_status, CASE WHEN raw_status IN ('approved', 'invoiced', 'processing') THEN 'confirmed'
  WHEN raw_status IN ('unavailable', 'canceled') THEN 'cancelled' ELSE raw_status END
  AS order_status, count(*) AS records FROM raw GROUP BY 1, 2"""

ORACLE["csv_roundtrip_scan"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'invoiced'
    ELSE 'unavailable' END AS order_status,
  CASE WHEN o_orderkey % 61 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END
    AS order_purchase_timestamp,
  CAST(NULL AS VARCHAR) AS order_delivered_customer_date,
  strftime(o_orderdate + INTERVAL 60 DAY, '%Y-%m-%d %H:%M:%S') AS order_estimated_delivery_date
FROM orders"""

ORACLE["event_json_publish"] = f"""WITH {_EV}
SELECT CAST(order_id AS VARCHAR) AS msg_key, batch_id AS kafka_partition,
  CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
  CAST(product_id AS VARCHAR) AS product_id, product_category,
  CAST(seller_id AS VARCHAR) AS seller_id, {_big('quantity')} AS quantity, unit_price,
  freight_value, total_price, order_status, customer_state, payment_type, payment_value,
  strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time,
  coalesce(strftime(order_delivered_ts, '%Y-%m-%d %H:%M:%S'), '') AS order_delivered_ts,
  strftime(order_estimated_ts, '%Y-%m-%d %H:%M:%S') AS order_estimated_ts FROM ev"""

ORACLE["parse_json_events"] = f"""WITH {_EV}, spoilt AS (
  SELECT *, product_id % 67 <> 0 AS whole, product_id % 61 <> 0 AS counted FROM ev)
SELECT CAST(order_id AS VARCHAR) AS msg_key, batch_id AS kafka_partition,
  product_id AS kafka_offset, 'true' AS has_text,
  CASE WHEN whole THEN CAST(product_id AS VARCHAR) END AS product_id,
  CASE WHEN whole AND counted THEN {_big('quantity')} END AS quantity,
  CASE WHEN whole THEN freight_value END AS freight_value,
  CASE WHEN whole THEN order_status END AS order_status,
  CASE WHEN whole THEN {_ts('event_ts')} END AS event_ts FROM spoilt"""

ORACLE["parse_event_timestamps"] = f"""WITH {_EV}
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id,
  CAST(seller_id AS VARCHAR) AS seller_id, freight_value, total_price,
  CASE WHEN product_id % 59 <> 0 AND product_id % 53 <> 0 THEN {_ts('event_ts')} END AS event_ts,
  {_ts('event_ts')} AS processing_ts FROM ev"""

# --- streams --------------------------------------------------------------------------

# Events as parsed from the wire: keys and times are text, blanks stay blanks.
_WIRE = _EV + """, wire AS (
  SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id,
      CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id,
      CAST(seller_id AS VARCHAR) AS seller_id,
      coalesce(strftime(order_delivered_ts, '%Y-%m-%d %H:%M:%S'), '') AS order_delivered_ts,
      strftime(order_estimated_ts, '%Y-%m-%d %H:%M:%S') AS order_estimated_ts,
      (shuffled_batch_id - 1) // 3 AS batch_id) FROM ev)"""
_WIRE_CHECKED = _WIRE + _CHECKED[len(_EV):].replace("FROM ev)", "FROM wire)")
_WIRE_TIES = ", ".join(f"{c} ASC NULLS FIRST" for c in (
    "customer_id", "product_id", "product_category", "seller_id", "quantity", "unit_price",
    "freight_value", "total_price", "order_status", "customer_state", "customer_city",
    "payment_type", "payment_value", "order_delivered_ts", "order_estimated_ts"))

_WIRE_SILVER = _WIRE_CHECKED + f""", silver_per_batch AS (
  SELECT * FROM checked WHERE is_valid QUALIFY row_number() OVER (
    PARTITION BY batch_id, order_id ORDER BY event_ts DESC NULLS LAST, {_WIRE_TIES}) = 1)"""

ORACLE["stream_medallion_pipeline"] = f"""WITH {_WIRE_SILVER}
SELECT batch_id, 'bronze' AS layer, count(*) AS records, {_total('payment_value')} AS amount
FROM checked GROUP BY batch_id
UNION ALL SELECT batch_id, 'quarantine', count(*), {_total('payment_value')}
FROM checked WHERE NOT is_valid GROUP BY batch_id
UNION ALL SELECT batch_id, 'silver', count(*), {_total('payment_value')}
FROM silver_per_batch GROUP BY batch_id"""

_WIRE_BATCHES = _WIRE_CHECKED + _BATCHES[len(_CHECKED):]
ORACLE["stream_metrics"] = f"""WITH {_WIRE_BATCHES}
SELECT 'replay' AS query, *, {_RUNNING} FROM batches"""

ORACLE["stream_upsert"] = f"""WITH {_WIRE_SILVER}, newest AS (
  SELECT * FROM silver_per_batch QUALIFY row_number() OVER (
    PARTITION BY order_id ORDER BY event_ts DESC NULLS LAST, batch_id DESC, {_WIRE_TIES}) = 1)
SELECT order_id, product_id, seller_id, total_price, order_status,
  {_ts('event_ts')} AS event_ts, (batch_id + 1) * 1000 AS _commit_time FROM newest"""

ORACLE["stream_restart_no_duplicates"] = f"""WITH {_WIRE}
SELECT batch_id, count(*) AS records, count(DISTINCT order_id) AS orders,
  {_total('freight_value')} AS freight FROM wire GROUP BY batch_id"""

ORACLE["stream_envelope_replay"] = f"""
SELECT CAST(user_id AS VARCHAR) AS msg_key, 'orders' AS topic, user_id % 3 AS kafka_partition,
  event_id AS kafka_offset, {_ts('ts')} AS kafka_ts, event_id, event_type, value FROM events"""

ORACLE["console_valid_view"] = f"""WITH {_WIRE_CHECKED}
SELECT order_id, customer_id, product_id, product_category, {_big('quantity')} AS quantity,
  total_price, order_status, customer_state, payment_type, {_ts('event_ts')} AS event_ts
FROM checked WHERE is_valid"""

ORACLE["console_quarantine_view"] = f"""WITH {_WIRE_CHECKED}
SELECT order_id, product_id AS json_product_id, {_TEXT_FLAGS} FROM checked WHERE NOT is_valid"""

ORACLE["late_event_split"] = f"""WITH arrived AS (
  SELECT *, CAST(strftime(ts + CASE WHEN event_id % 50 = 0 THEN INTERVAL 36 HOUR
    ELSE INTERVAL 0 HOUR END, '%Y%m%d') AS BIGINT) AS arrival_day FROM events), days AS (
  SELECT arrival_day, max(ts) AS newest FROM arrived GROUP BY arrival_day), marks AS (
  SELECT arrival_day, max(newest) OVER (ORDER BY arrival_day
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS watermark FROM days)
SELECT event_id, arrival_day, {_ts('ts')} AS ts, {_ts('watermark')} AS watermark,
  CAST(coalesce(ts <= watermark, false) AS VARCHAR) AS is_late
FROM arrived JOIN marks USING (arrival_day)"""

# --- files, bitmaps, numbering, progress ---------------------------------------------------

ORACLE["small_files_compacted"] = f"""WITH {_CHECKED}
SELECT customer_state, count(*) AS records, {_total('total_price')} AS amount,
  1::BIGINT AS files, CAST(customer_state < 'M' AS VARCHAR) AS untouched
FROM checked GROUP BY customer_state"""
ORACLE["table_files"] = f"""WITH {_EV}
SELECT customer_state, 1::BIGINT AS files, count(*) AS records FROM ev GROUP BY customer_state"""

ORACLE["distinct_orders_merged"] = f"""WITH {_EV}
SELECT batch_id, count(DISTINCT order_id) AS distinct_keys FROM ev GROUP BY batch_id
UNION ALL SELECT NULL, count(DISTINCT order_id) FROM ev"""
ORACLE["distinct_customers_rolling"] = f"""WITH {_EV}, seen AS (
  SELECT DISTINCT CAST(event_ts AS DATE) AS day, customer_id FROM ev WHERE event_ts IS NOT NULL),
days AS (SELECT DISTINCT day FROM seen)
SELECT strftime(days.day, '%Y-%m-%d') AS day, count(DISTINCT customer_id) AS distinct_keys
FROM days JOIN seen ON seen.day BETWEEN days.day - 6 AND days.day GROUP BY days.day"""

_CHANGED = _orders_log() + f", silver AS (SELECT * FROM {_latest_orders()})"
for _name in ("daily_revenue", "state_metrics", "status_funnel", "category_performance"):
    ORACLE[f"gold_{_name.split('_')[0]}_from_changes"] = ORACLE[f"gold_{_name}"].replace(
        f"WITH {_SILVER}", f"WITH {_CHANGED}")

ORACLE["replay_order"] = f"""SELECT event_time, order_id, product_id, seller_id, total_price,
  row_number() OVER (ORDER BY event_time, order_id, product_id, seller_id, total_price) AS replay_number
FROM ({ORACLE['enriched_order_events']})"""

ORACLE["last_customer_in_file_order"] = f"""
SELECT c_custkey AS customer_id, [{_STATE_LIST}][c_nationkey + 1] AS customer_state,
  CASE WHEN c_custkey % 3 = 0 THEN 'moved' ELSE c_mktsegment END AS customer_city
FROM customer WHERE c_custkey % 40 <> 0"""

ORACLE["stream_progress"] = f"""WITH {_WIRE}, counted AS (
  SELECT batch_id, count(*) AS input_rows FROM wire GROUP BY batch_id)
SELECT query, batch_id, input_rows
FROM counted, (VALUES ('valid-view'), ('quarantine-view')) AS q(query)"""

# --- reports through catalog views -----------------------------------------------------

for _name in ("daily_revenue_trend", "top_states_revenue", "top_categories", "hourly_distribution",
              "payment_method_breakdown", "customer_concentration", "delivery_sla"):
    ORACLE[f"view_{_name}"] = ORACLE[_name]
ORACLE["view_status_funnel"] = ORACLE["status_funnel_pct"]
