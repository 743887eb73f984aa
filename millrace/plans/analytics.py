"""The eight BI queries, each a function of gold tables or of silver.

Windows without a partition run over gold rows only: days, states, statuses
and categories, never events.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.measures import MONEY, mean, total
from millrace.schema import DEFAULT_DATABASE


def _rounded(name: str, digits: int = 2) -> Column:
    return F.round(F.col(name), digits)


def _share(part: Column, whole: Column) -> Column:
    return F.round(part * F.lit(100.0).cast("double") / whole, 1)


def daily_revenue_trend(gold_daily_revenue: DataFrame) -> DataFrame:
    """Revenue by day with the average of the last seven rows."""
    week = Window.orderBy("order_date").rowsBetween(-6, Window.currentRow)
    amount = F.col("total_revenue").cast(MONEY)
    moving = F.sum(amount).over(week).cast("double") / F.count(amount).over(week)
    return gold_daily_revenue.select(
        "order_date",
        _rounded("total_revenue").alias("revenue"),
        "order_count",
        _rounded("avg_order_value").alias("aov"),
        F.round(moving, 2).alias("revenue_7d_ma"),
    ).orderBy("order_date")


def top_states_revenue(gold_state_metrics: DataFrame, states: int = 10) -> DataFrame:
    """The states with the highest revenue and how often they are served late."""
    top = gold_state_metrics.orderBy(F.col("total_revenue").desc(), "customer_state").limit(states)
    return top.select(
        "customer_state",
        _rounded("total_revenue").alias("revenue"),
        "order_count",
        _rounded("avg_order_value").alias("aov"),
        _rounded("avg_delivery_delay_hrs", 1).alias("avg_delay_hrs"),
        "late_deliveries",
        _rounded("late_delivery_pct", 1).alias("late_pct"),
    )


def status_funnel_pct(gold_status_funnel: DataFrame) -> DataFrame:
    """Orders by status with their share of all orders."""
    everything = Window.partitionBy()
    return gold_status_funnel.select(
        "order_status",
        "order_count",
        _rounded("total_revenue").alias("revenue"),
        _rounded("avg_order_value").alias("aov"),
        _share(F.col("order_count"), F.sum("order_count").over(everything)).alias("pct_of_total"),
    ).orderBy(F.col("order_count").desc())


def top_categories(gold_category_performance: DataFrame, rank: int = 20) -> DataFrame:
    """Categories up to a revenue rank."""
    return gold_category_performance.where(F.col("revenue_rank") <= rank).select(
        "product_category",
        "revenue_rank",
        _rounded("total_revenue").alias("revenue"),
        "total_qty",
        "order_count",
        _rounded("avg_unit_price").alias("avg_price"),
    ).orderBy("revenue_rank")


def payment_method_breakdown(orders_silver: DataFrame) -> DataFrame:
    """Revenue by payment type. The grand total is added up from the groups, so
    silver is read once."""
    by_type = orders_silver.groupBy("payment_type").agg(
        F.countDistinct("order_id").alias("order_count"),
        total("total_price").alias("revenue"),
        mean("total_price").alias("aov"),
    )
    everything = F.sum(F.col("revenue").cast(MONEY)).over(Window.partitionBy()).cast("double")
    return by_type.select(
        "payment_type",
        "order_count",
        _rounded("revenue").alias("total_revenue"),
        _rounded("aov").alias("avg_order_value"),
        _share(F.col("revenue"), everything).alias("revenue_pct"),
    ).orderBy(F.col("total_revenue").desc())


def hourly_distribution(orders_silver: DataFrame) -> DataFrame:
    """Orders and revenue by hour of the day."""
    return orders_silver.groupBy(F.hour("event_ts").alias("order_hour")).agg(
        F.countDistinct("order_id").alias("order_count"),
        F.round(total("total_price"), 2).alias("total_revenue"),
        F.round(mean("total_price"), 2).alias("avg_order_value"),
    ).orderBy("order_hour")


def customer_concentration(gold_state_metrics: DataFrame) -> DataFrame:
    """States by orders with the running share; states with equal counts share it."""
    down_to_here = Window.orderBy(F.col("order_count").desc())
    running = F.sum("order_count").over(down_to_here)
    everything = F.sum("order_count").over(Window.partitionBy())
    return gold_state_metrics.select(
        "customer_state",
        "order_count",
        _rounded("total_revenue").alias("revenue"),
        _share(running, everything).alias("cumulative_pct"),
    ).orderBy(F.col("order_count").desc())


def delivery_sla(gold_state_metrics: DataFrame) -> DataFrame:
    """Share of rows that were not late, by state; undelivered ones count as on time."""
    on_time = F.col("total_records") - F.col("late_deliveries")
    return gold_state_metrics.select(
        "customer_state",
        F.col("total_records").alias("total_orders"),
        "late_deliveries",
        on_time.alias("on_time"),
        _share(on_time, F.col("total_records")).alias("on_time_pct"),
        _rounded("avg_delivery_delay_hrs", 1).alias("avg_delay_hrs"),
    ).orderBy(F.col("on_time_pct").desc())


@dataclass(frozen=True)
class Report:
    title: str
    table: str
    build: Callable[[DataFrame], DataFrame]


SUITE: dict[str, Report] = {
    "daily_revenue_trend": Report(
        "Daily revenue with 7-day moving average", "gold_daily_revenue", daily_revenue_trend),
    "top_states_revenue": Report(
        "Top states by revenue and late deliveries", "gold_state_metrics", top_states_revenue),
    "status_funnel": Report(
        "Orders by status", "gold_status_funnel", status_funnel_pct),
    "top_categories": Report(
        "Top product categories by revenue", "gold_category_performance", top_categories),
    "payment_method_breakdown": Report(
        "Revenue by payment method", "orders_silver", payment_method_breakdown),
    "hourly_distribution": Report(
        "Orders by hour of day", "orders_silver", hourly_distribution),
    "customer_concentration": Report(
        "Order concentration by state", "gold_state_metrics", customer_concentration),
    "delivery_sla": Report(
        "On-time deliveries by state", "gold_state_metrics", delivery_sla),
}


def run_report(spark: SparkSession, name: str, database: str = DEFAULT_DATABASE) -> DataFrame:
    """One report of the suite over the catalog's tables."""
    report = SUITE[name]
    return report.build(spark.table(f"{database}.{report.table}"))
