"""Order-item events from the shop's five tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import (
    blank_to_null, normalize_status, shop_time_to_event_time,
)
from millrace.functions.measures import total
from millrace.operators.latest import latest_per_key


def payments_per_order(payments: DataFrame, sequence: str = "payment_sequential") -> DataFrame:
    """Paid sum and the type of the first payment, per order."""
    return payments.groupBy("order_id").agg(
        total("payment_value").alias("payment_value"),
        F.min_by("payment_type", sequence).alias("payment_type"),
    )


def last_row(df: DataFrame, key: str, sequence: str | None) -> DataFrame:
    """One row per key; with repeats the highest ``sequence`` counts."""
    if sequence is None:
        return df
    rest = [F.col(name).asc_nulls_first() for name in df.columns if name not in (key, sequence)]
    return latest_per_key(df, [key], [F.col(sequence).desc_nulls_last(), *rest]).drop(sequence)


def order_item_events(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    customer_sequence: str | None = None,
    product_sequence: str | None = None,
) -> DataFrame:
    """One event per order item of every order with a purchase time.

    Lookups that find nothing give ``unknown``, a missing payment gives 0. The
    order side is completed first, because it is narrower and has one row per
    order; then items join it. Items may crowd on single orders or products; Spark
    sizes up the sides while it runs, broadcasts small ones and splits hot keys.
    """
    customers = last_row(customers, "customer_id", customer_sequence)
    products = last_row(products, "product_id", product_sequence)

    order_side = (
        orders.where(blank_to_null("order_purchase_timestamp").isNotNull())
        .join(customers.select("customer_id", "customer_state", "customer_city"),
              "customer_id", "left")
        .join(payments_per_order(payments), "order_id", "left")
    )
    lines = items.select(
        "order_id", "product_id", "seller_id", "price", "freight_value",
    ).join(
        products.select(
            "product_id", F.lit(True).alias("known_product"),
            blank_to_null("product_category_name").alias("product_category"),
        ),
        "product_id", "left",
    )
    matched = lines.join(order_side, "order_id")

    unknown, nothing = F.lit("unknown"), F.lit(0.0)
    price, freight = F.coalesce("price", nothing), F.coalesce("freight_value", nothing)
    return matched.select(
        "order_id", "customer_id",
        F.coalesce("product_id", unknown).alias("product_id"),
        # A known product without a category stays without one.
        F.when(F.col("known_product"), F.col("product_category")).otherwise(unknown)
        .alias("product_category"),
        F.coalesce("seller_id", unknown).alias("seller_id"),
        F.lit(1).alias("quantity"),
        F.round(price, 2).alias("unit_price"),
        F.round(freight, 2).alias("freight_value"),
        F.round(price + freight, 2).alias("total_price"),
        normalize_status(F.coalesce("order_status", F.lit("created"))).alias("order_status"),
        F.coalesce("customer_state", unknown).alias("customer_state"),
        F.coalesce("customer_city", unknown).alias("customer_city"),
        F.coalesce("payment_type", unknown).alias("payment_type"),
        F.round(F.coalesce("payment_value", nothing), 2).alias("payment_value"),
        shop_time_to_event_time("order_purchase_timestamp").alias("event_time"),
        F.col("order_delivered_customer_date").alias("order_delivered_ts"),
        F.col("order_estimated_delivery_date").alias("order_estimated_ts"),
    )


def chronological(events: DataFrame) -> DataFrame:
    """Replay order; ties are settled so that ranges can split equal times."""
    return events.orderBy("event_time", "order_id", "product_id", "seller_id", "total_price")
