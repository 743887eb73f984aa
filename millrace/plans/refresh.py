"""Gold tables that follow the change log: a refresh reads what changed, not silver.

Per group a table of parts is kept, integers that add up: rows, orders, and of each amount its
exact limbs. A changed order takes its old version out of its old group and adds the new
one to the new group, which may be another. Gold is a projection of the parts, equal to the full
build to the last bit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import seconds_between, time_of
from millrace.functions.measures import NOT_FINITE, amount_parts, put_together
from millrace.operators import versions
from millrace.operators.versions import Versioning
from millrace.plans import gold

SIGN = "_sign"


@dataclass(frozen=True)
class Parts:
    """What of silver rows is added up for one gold table: its ``key``, ``amounts`` of money,
    ``counts`` (integers per row) and ``finish``, which makes the gold table of the sums."""

    key: str
    key_of: Column
    amounts: tuple[str, ...]
    finish: Callable[[DataFrame], DataFrame]
    counts: Callable[[DataFrame], dict[str, Column]] = field(default=lambda rows: {})
    where: Column | None = None


def row_changes(log: DataFrame, v: Versioning, after, until=None) -> DataFrame:
    """Rows that became current after one commit (``_sign`` 1) and the rows they replaced (-1).

    Of the older log only the changed keys are ranked.
    """
    new = versions.changes(log, v, after, until)
    changed = log.join(new.select(*v.keys), list(v.keys), "left_semi")
    old = versions.as_of(changed, v, after)
    return new.withColumn(SIGN, F.lit(1)).unionByName(old.withColumn(SIGN, F.lit(-1)))


def first_rows(current: DataFrame) -> DataFrame:
    """A whole table as changes to nothing."""
    return current.withColumn(SIGN, F.lit(1))


def parts_of(changes: DataFrame, table: Parts) -> DataFrame:
    """Sums of the signed parts of changed rows, one row per group."""
    rows = changes if table.where is None else changes.where(table.where)
    parts = {"rows": F.lit(1), "orders": F.col("order_id").isNotNull().cast("int"),
             **table.counts(rows)}
    for amount in table.amounts:
        parts |= {f"{amount}_{name}": value for name, value in amount_parts(amount).items()}
        parts[f"{amount}_n"] = F.col(amount).isNotNull().cast("int")
    return rows.groupBy(table.key_of.alias(table.key)).agg(*(
        F.sum(F.col(SIGN) * F.coalesce(value, F.lit(0))).alias(name)
        for name, value in parts.items()))


def merged(stored: DataFrame, delta: DataFrame, table: Parts) -> DataFrame:
    """Stored parts with those of changes; groups that lost their last row are gone."""
    names = [name for name in stored.columns if name != table.key]
    return stored.unionByName(delta).groupBy(table.key).agg(
        *(F.sum(name).alias(name) for name in names)).where("rows > 0")


def amount(name: str) -> Column:
    parts = {part: F.col(f"{name}_{part}") for part in amount_parts(name)}
    nan, plus, minus = (parts[p] for p in NOT_FINITE)
    rest = (
        F.when((nan > 0) | ((plus > 0) & (minus > 0)), F.lit(float("nan")))
        .when(plus > 0, F.lit(float("inf"))).when(minus > 0, F.lit(float("-inf")))
        .when(parts["beyond_n"] > 0, parts["beyond"])
    )
    return F.when(F.col(f"{name}_n") > 0, put_together(parts, rest))


def mean_amount(name: str) -> Column:
    return amount(name) / F.nullif(F.col(f"{name}_n"), F.lit(0))


def _order_measures() -> list[Column]:
    return [amount("total_price").alias("total_revenue"), F.col("orders").alias("order_count"),
            mean_amount("total_price").alias("avg_order_value")]


def _daily(sums: DataFrame) -> DataFrame:
    return gold.with_day_ratios(sums.select(
        "order_date", *_order_measures(), amount("freight_value").alias("total_freight"),
        mean_amount("freight_value").alias("avg_freight")))


def _delays(rows: DataFrame) -> dict[str, Column]:
    delay = seconds_between(time_of(rows, "order_delivered_ts"), time_of(rows, "order_estimated_ts"))
    return {"delay": delay, "delays": delay.isNotNull().cast("int"), "late": (delay > 0).cast("int")}


def _state(sums: DataFrame) -> DataFrame:
    return gold.with_late_share(sums.select(
        "customer_state", *_order_measures(),
        (F.col("delay") / F.lit(3600.0) / F.nullif("delays", F.lit(0))).alias("avg_delivery_delay_hrs"),
        F.col("late").alias("late_deliveries"), F.col("rows").alias("total_records")))


def _category(sums: DataFrame) -> DataFrame:
    return gold.with_revenue_rank(sums.select(
        "product_category", *_order_measures(),
        F.when(F.col("quantities") > 0, F.col("quantity")).alias("total_qty"),
        mean_amount("unit_price").alias("avg_unit_price")))


def tables() -> dict[str, Parts]:
    """Mode name to parts, as ``gold.GOLD_TABLES``."""
    return {
        "daily": Parts("order_date", F.to_date("event_ts"), ("total_price", "freight_value"), _daily),
        "state": Parts("customer_state", F.col("customer_state"), ("total_price",), _state, _delays),
        "status": Parts("order_status", F.col("order_status"), ("total_price",),
                        lambda sums: sums.select("order_status", *_order_measures())),
        "category": Parts(
            "product_category", F.col("product_category"), ("total_price", "unit_price"), _category,
            lambda rows: {"quantity": F.col("quantity").cast("bigint"),
                          "quantities": F.col("quantity").isNotNull().cast("int")},
            F.col("product_category").isNotNull()),
    }


def refreshed(stored: DataFrame, log: DataFrame, v: Versioning, steps, table: Parts) -> DataFrame:
    """Parts brought up to date over successive (after, until) pairs."""
    return reduce(lambda parts, step: merged(
        parts, parts_of(row_changes(log, v, *step), table), table), steps, stored)
