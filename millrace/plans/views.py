"""The eight reports as catalog objects that any SQL client can read.

Six are views; two are functions with a parameter by name, as ``SELECT * FROM
report_top_states_revenue(states => 5)`` (Spark takes such a name without its database, so a client says
``USE`` first). They read the catalog's tables when they are asked, so a refreshed gold table
shows at once. Money of silver is summed as decimal(24,6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.analytics import SUITE
from millrace.schema import DEFAULT_DATABASE

_MONEY = "CAST({0} AS DECIMAL(24,6))"
_REVENUE = f"CAST(sum({_MONEY.format('total_price')}) AS DOUBLE)"
_AVERAGE = f"{_REVENUE} / nullif(count(total_price), 0)"


def _share(part: str, whole: str) -> str:
    return f"round({part} * 100.0D / {whole}, 1)"


VIEWS = {
    "daily_revenue_trend": f"""
        SELECT order_date, round(total_revenue, 2) AS revenue, order_count,
          round(avg_order_value, 2) AS aov,
          round(CAST(sum({_MONEY.format('total_revenue')}) OVER week AS DOUBLE)
                / count(total_revenue) OVER week, 2) AS revenue_7d_ma
        FROM {{table}}
        WINDOW week AS (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "status_funnel": f"""
        SELECT order_status, order_count, round(total_revenue, 2) AS revenue,
          round(avg_order_value, 2) AS aov,
          {_share('order_count', 'sum(order_count) OVER ()')} AS pct_of_total
        FROM {{table}}""",
    "payment_method_breakdown": f"""
        SELECT payment_type, order_count, round(revenue, 2) AS total_revenue,
          round(aov, 2) AS avg_order_value,
          {_share('revenue', f"CAST(sum({_MONEY.format('revenue')}) OVER () AS DOUBLE)")} AS revenue_pct
        FROM (SELECT payment_type, count(DISTINCT order_id) AS order_count,
                {_REVENUE} AS revenue, {_AVERAGE} AS aov
              FROM {{table}} GROUP BY payment_type)""",
    "hourly_distribution": f"""
        SELECT hour(event_ts) AS order_hour, count(DISTINCT order_id) AS order_count,
          round({_REVENUE}, 2) AS total_revenue, round({_AVERAGE}, 2) AS avg_order_value
        FROM {{table}} GROUP BY hour(event_ts)""",
    "customer_concentration": f"""
        SELECT customer_state, order_count, round(total_revenue, 2) AS revenue,
          {_share('sum(order_count) OVER (ORDER BY order_count DESC)',
                  'sum(order_count) OVER ()')} AS cumulative_pct
        FROM {{table}}""",
    "delivery_sla": f"""
        SELECT customer_state, total_records AS total_orders, late_deliveries,
          total_records - late_deliveries AS on_time,
          {_share('(total_records - late_deliveries)', 'total_records')} AS on_time_pct,
          round(avg_delivery_delay_hrs, 1) AS avg_delay_hrs
        FROM {{table}}""",
}

#: Parameter with its default, columns, text.
FUNCTIONS = {
    "top_states_revenue": (
        "states INT DEFAULT 10",
        "customer_state STRING, revenue DOUBLE, order_count BIGINT, aov DOUBLE, "
        "avg_delay_hrs DOUBLE, late_deliveries BIGINT, late_pct DOUBLE",
        """SELECT customer_state, round(total_revenue, 2), order_count, round(avg_order_value, 2),
          round(avg_delivery_delay_hrs, 1), late_deliveries, round(late_delivery_pct, 1)
        FROM (SELECT *, row_number() OVER (
                ORDER BY total_revenue DESC, customer_state) AS place FROM {table})
        WHERE place <= states"""),
    "top_categories": (
        "up_to INT DEFAULT 20",
        "product_category STRING, revenue_rank INT, revenue DOUBLE, total_qty BIGINT, "
        "order_count BIGINT, avg_price DOUBLE",
        """SELECT product_category, revenue_rank, round(total_revenue, 2), total_qty, order_count,
          round(avg_unit_price, 2)
        FROM {table} WHERE revenue_rank <= up_to"""),
}


def create_report(spark: SparkSession, name: str, database: str = DEFAULT_DATABASE) -> None:
    """Make one report known as ``<database>.report_<name>``; an older one is replaced."""
    table, target = f"{database}.{SUITE[name].table}", f"{database}.report_{name}"
    if name in VIEWS:
        spark.sql(f"CREATE OR REPLACE VIEW {target} AS {VIEWS[name].format(table=table)}")
    else:
        parameter, columns, text = FUNCTIONS[name]
        spark.sql(f"CREATE OR REPLACE FUNCTION {target}({parameter}) RETURNS TABLE ({columns}) "
                  f"RETURN {text.format(table=table)}")


def read_report(
    spark: SparkSession, name: str, database: str = DEFAULT_DATABASE, **parameters: int
) -> DataFrame:
    """A report through its view or function, as a client would read it."""
    if name in VIEWS:
        return spark.table(f"{database}.report_{name}")
    given = ", ".join(f"{key} => {int(value)}" for key, value in parameters.items())
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        return spark.sql(f"SELECT * FROM report_{name}({given})")
    finally:
        spark.catalog.setCurrentDatabase(before)
