"""The given tables, mapped to the inputs the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import format_event_time
from millrace.operators.quality import valid_rows, with_quality_flags
from millrace.operators.sizes import estimated_bytes
from millrace.operators.versions import Versioning
from millrace.schema import STATES
from millrace.sources.catalog import shuffle_width

# Settles versions of an order that have the same event time.
TIES = ("product_id", "seller_id", "freight_value", "total_price", "quantity",
        "order_delivered_ts")

ORDERS_LOG = Versioning(keys=("order_id",), event_time="event_ts", ties=TIES)
USERS_LOG = Versioning(keys=("user_id",), event_time="ts", ties=("event_id",))


# Columns of the tables the queries read. A given schema spares a job per read.
TABLE_DDL = {
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_type STRING, p_retailprice DOUBLE",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table as it lies."""
    return spark.read.schema(TABLE_DDL[name]).parquet(f"{sf}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("l_partkey") % n == 0


# Line items as the table stores them: from where on a table is large, and how many go to one
# partition of its events.
LARGE_BYTES = 32 * 1024 * 1024
PARTITION_BYTES = 4 * 1024 * 1024


def event_partitions(spark: SparkSession, sf: str) -> int | None:
    """Partitions of the events of a large table, so that a task's rows do not grow with it.
    None leaves the number to Spark."""
    stored = estimated_bytes(table(spark, sf, "lineitem"))
    return max(shuffle_width(spark), stored // PARTITION_BYTES) if stored > LARGE_BYTES else None


def order_events(spark: SparkSession, sf: str, parts: int | None = None) -> DataFrame:
    """Order-item events with faults that follow from the part key, so that
    every quality rule meets rows that break it. The events of a large table come in
    ``parts`` partitions by order, or as many as its size asks for."""
    # Orders come last: their join leaves an order's rows in one partition, where the newest
    # version of each is found without another exchange, and no other join moves wide rows.
    asked = event_partitions(spark, sf)
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    # What is made of an item alone is made here, so that less of it moves.
    items = table(spark, sf, "lineitem").withColumn(
        "delivered", F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    ).drop("l_linestatus", "l_shipdate").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if asked is not None:
        # Merged, the events keep these partitions; a broadcast of the items would not keep them.
        items = items.repartition(parts or asked, "l_orderkey").hint("merge")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped").otherwise("created")
    )
    state = F.element_at(F.array(*map(F.lit, STATES)), F.col("c_nationkey") + 1)
    ordered_at = F.expr("o_orderdate + make_dt_interval(0, l_linenumber)")
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(~_every(20), F.col("p_type")).alias("product_category"),
        F.col("l_suppkey").alias("seller_id"),
        F.when(_every(83), 0).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        (F.col("l_linenumber") * 2.5).cast("double").alias("freight_value"),
        F.when(_every(79), -1.0).otherwise(F.col("l_extendedprice")).alias("total_price"),
        F.when(_every(89), None).when(_every(97), "bogus").otherwise(status)
        .alias("order_status"),
        F.when(_every(71), "XX").otherwise(state).alias("customer_state"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("o_orderpriority").alias("payment_type"),
        F.col("o_totalprice").alias("payment_value"),
        F.when(~_every(73), ordered_at).alias("event_ts"),
        F.col("delivered").alias("order_delivered_ts"),
        F.expr("o_orderdate + INTERVAL 60 DAYS").alias("order_estimated_ts"),
        F.col("l_linenumber").cast("bigint").alias("batch_id"),
        F.expr("CAST(1 + (l_linenumber * 3) % 7 AS BIGINT)").alias("shuffled_batch_id"),
    )


def checked_events(spark: SparkSession, sf: str) -> DataFrame:
    return with_quality_flags(order_events(spark, sf))


def orders_log(spark: SparkSession, sf: str, commit: str = "shuffled_batch_id") -> DataFrame:
    """Valid events as a change log; the shuffled commits bring older events late."""
    valid = valid_rows(checked_events(spark, sf))
    return valid.withColumn(ORDERS_LOG.commit, F.col(commit)).drop("batch_id", "shuffled_batch_id")


def users_log(spark: SparkSession, sf: str) -> DataFrame:
    """User events as a change log with one commit per day."""
    day = F.date_format("ts", "yyyyMMdd").cast("bigint")
    return table(spark, sf, "events").withColumn(USERS_LOG.commit, day)


def event_payloads(spark: SparkSession, sf: str, parts: int | None = None) -> DataFrame:
    """Events as they are on the wire: keys and times as text. With ``parts`` they come in
    so many partitions, dealt out before they become text; those of a large table by its joins."""
    text_time = "yyyy-MM-dd HH:mm:ss"
    events = order_events(spark, sf, parts)
    if parts is not None and event_partitions(spark, sf) is None:
        events = events.repartition(parts)
    return events.withColumns({
        **{name: F.col(name).cast("string")
           for name in ("order_id", "customer_id", "product_id", "seller_id")},
        "event_time": format_event_time("event_ts"),
        # Undelivered orders carry an empty string, as the shop's files do.
        "order_delivered_ts": F.coalesce(F.date_format("order_delivered_ts", text_time), F.lit("")),
        "order_estimated_ts": F.date_format("order_estimated_ts", text_time),
        "processing_time": F.date_format(
            "event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
    }).drop("event_ts")


def shop_tables(spark: SparkSession, sf: str, unpaid: int | None = 10) -> dict[str, DataFrame]:
    """The five relational inputs of the enrichment, with gaps in each lookup. Every
    ``unpaid``-th order has no payment."""
    orders = table(spark, sf, "orders")
    items = table(spark, sf, "lineitem")
    customer = table(spark, sf, "customer")
    part = table(spark, sf, "part")
    raw_status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "invoiced").otherwise("unavailable")
    )
    bought = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    state = F.element_at(F.array(*map(F.lit, STATES)), F.col("c_nationkey") + 1)
    paid = orders if unpaid is None else orders.where(F.col("o_orderkey") % unpaid != 0)
    first = paid.select(
        F.col("o_orderkey").alias("order_id"), F.lit(1).alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        F.col("o_totalprice").alias("payment_value"),
    )
    second = paid.where("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").alias("order_id"), F.lit(2).alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"), F.lit(10.0).alias("payment_value"),
    )
    return {
        "orders": orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            raw_status.alias("order_status"),
            F.when(F.col("o_orderkey") % 61 == 0, "").otherwise(bought)
            .alias("order_purchase_timestamp"),
            F.lit(None).cast("string").alias("order_delivered_customer_date"),
            F.date_format(F.expr("o_orderdate + INTERVAL 60 DAYS"), "yyyy-MM-dd HH:mm:ss")
            .alias("order_estimated_delivery_date"),
        ),
        "items": items.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_linenumber") * 2.5).cast("double").alias("freight_value"),
        ),
        "payments": first.unionByName(second),
        "customers": customer.where("c_custkey % 40 != 0").select(
            F.col("c_custkey").alias("customer_id"),
            state.alias("customer_state"), F.col("c_mktsegment").alias("customer_city"),
        ),
        "products": part.where("p_partkey % 50 != 0").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
        ),
    }
