"""Adding nullable columns to a table that already has rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import time_of

ADDED_COLUMNS = ("review_score", "delivery_delay_days")


def already_evolved(df: DataFrame, columns: Sequence[str] = ADDED_COLUMNS) -> bool:
    return set(columns) <= set(df.columns)


def review_score(key: str, portable: bool = False) -> Column:
    """A made-up score of 1 to 5 that follows from the key.

    ``pmod`` is safe for the smallest hash value, whose absolute value would
    overflow. ``portable`` takes a numeric key itself, for other engines.
    """
    number = F.col(key).cast("bigint") if portable else F.hash(key)
    return (F.pmod(number, F.lit(5)) + 1).cast("int")


def delivery_delay_days(df: DataFrame) -> Column:
    """Whole days from estimate to delivery, NULL unless both dates exist."""
    delivered = time_of(df, "order_delivered_ts")
    estimated = time_of(df, "order_estimated_ts")
    return F.datediff(delivered, estimated).cast("double")


def with_added_columns(df: DataFrame, key: str = "order_id", portable: bool = False) -> DataFrame:
    return df.withColumns({
        "review_score": review_score(key, portable),
        "delivery_delay_days": delivery_delay_days(df),
    })


def sample_to_evolve(current: DataFrame, rows: int = 100, key: str = "order_id") -> DataFrame:
    """The ``rows`` delivered orders with the smallest keys: a sampling operator."""
    delivered = current.where(F.col("order_status") == "delivered")
    return delivered.orderBy(key).limit(rows)


def null_audit(df: DataFrame, columns: Sequence[str] = ADDED_COLUMNS) -> DataFrame:
    """NULL and non-NULL rows of each column that exists, in one pass."""
    present = [name for name in columns if name in df.columns]
    counts = df.agg(*(F.count(name).alias(name) for name in present), F.count("*").alias("_rows"))
    return _per_column(counts, present).select(
        "column_name", "not_null_records",
        (F.col("_rows") - F.col("not_null_records")).alias("null_records"),
    )


def schema_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Name, type and filled rows of every column of ``after``, and whether it is new."""
    counts = after.agg(*(F.count(name).alias(name) for name in after.columns))
    types = {field.name: field.dataType.simpleString() for field in after.schema}
    nullable = {field.name: field.nullable for field in after.schema}
    return _per_column(counts, after.columns).select(
        "column_name",
        _lookup(types, "column_name").alias("data_type"),
        _lookup(nullable, "column_name").alias("nullable"),
        (~F.col("column_name").isin(before.columns)).alias("is_new"),
        "not_null_records",
    )


def _per_column(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    rest = [name for name in counts.columns if name not in names]
    return counts.unpivot(rest, list(names), "column_name", "not_null_records")


def _lookup(values: dict, key: str) -> Column:
    entries = [F.lit(item) for pair in values.items() for item in pair]
    return F.element_at(F.create_map(*entries), F.col(key))
