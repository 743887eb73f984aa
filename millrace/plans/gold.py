"""The four gold tables, each one aggregation of the silver layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import seconds_between, time_of
from millrace.functions.measures import mean, mean_hours, percent, total
from millrace.operators.latest import latest_per_key, newest_first

UPDATED = "agg_updated_ts"


def order_measures() -> list:
    """What every gold table says about its group."""
    return [
        total("total_price").alias("total_revenue"),
        F.countDistinct("order_id").alias("order_count"),
        mean("total_price").alias("avg_order_value"),
    ]


def daily_revenue(silver: DataFrame) -> DataFrame:
    days = silver.groupBy(F.to_date("event_ts").alias("order_date")).agg(
        *order_measures(),
        total("freight_value").alias("total_freight"),
        mean("freight_value").alias("avg_freight"),
    )
    return with_day_ratios(days)


def with_day_ratios(days: DataFrame) -> DataFrame:
    return days.withColumns({
        "revenue_per_order": F.round(F.col("total_revenue") / F.col("order_count"), 2),
        "date_key": F.date_format("order_date", "yyyyMMdd"),
    })


def state_metrics(silver: DataFrame) -> DataFrame:
    """Revenue and lateness by state. The percentage is of all rows, so orders
    that have not been delivered count as not late."""
    delay = seconds_between(time_of(silver, "order_delivered_ts"),
                            time_of(silver, "order_estimated_ts"))
    states = silver.withColumn("_delay", delay).groupBy("customer_state").agg(
        *order_measures(),
        mean_hours(F.col("_delay")).alias("avg_delivery_delay_hrs"),
        F.count_if(F.col("_delay") > 0).alias("late_deliveries"),
        F.count("*").alias("total_records"),
    )
    return with_late_share(states)


def with_late_share(states: DataFrame) -> DataFrame:
    return states.withColumn(
        "late_delivery_pct", percent(F.col("late_deliveries"), F.col("total_records"))
    )


def status_funnel(silver: DataFrame) -> DataFrame:
    return silver.groupBy("order_status").agg(*order_measures())


def category_performance(silver: DataFrame) -> DataFrame:
    """Ranked by revenue; the ranking sees one row per category."""
    categories = silver.where(F.col("product_category").isNotNull()).groupBy("product_category")
    return with_revenue_rank(categories.agg(
        *order_measures(),
        F.sum("quantity").alias("total_qty"),
        mean("unit_price").alias("avg_unit_price"),
    ))


def with_revenue_rank(categories: DataFrame) -> DataFrame:
    ranked = F.dense_rank().over(Window.orderBy(F.col("total_revenue").desc()))
    return categories.withColumn("revenue_rank", ranked)


# Mode name to (table, key, builder).
GOLD_TABLES: dict[str, tuple[str, str, Callable[[DataFrame], DataFrame]]] = {
    "daily": ("gold_daily_revenue", "date_key", daily_revenue),
    "state": ("gold_state_metrics", "customer_state", state_metrics),
    "status": ("gold_status_funnel", "order_status", status_funnel),
    "category": ("gold_category_performance", "product_category", category_performance),
}


def with_update_time(gold: DataFrame) -> DataFrame:
    return gold.withColumn(UPDATED, F.current_timestamp())


def refreshed(existing: DataFrame, update: DataFrame, key: str) -> DataFrame:
    """Upsert of one gold table: the row updated last per key. Both sides are
    aggregates, one row per key each."""
    rows = existing.unionByName(update, allowMissingColumns=True)
    return latest_per_key(rows, [key], newest_first(UPDATED))


def write_gold(gold: DataFrame, path: str) -> None:
    """Full refresh. The aggregate runs once: nothing counts it beforehand."""
    with_update_time(gold).write.mode("overwrite").parquet(path)


def build_all(silver: DataFrame, modes=tuple(GOLD_TABLES)) -> dict[str, DataFrame]:
    """Table name to lazy DataFrame for the chosen modes."""
    return {GOLD_TABLES[mode][0]: GOLD_TABLES[mode][2](silver) for mode in modes}
