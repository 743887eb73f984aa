"""Quality rules, the valid/quarantine split and quality figures."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.measures import percent
from millrace.schema import QC_FLAGS, STATES, STATUSES


def quality_rules() -> dict[str, Column]:
    """Flag name to rule. A rule over a missing value is NULL, not false."""
    rules = (
        F.col("order_id").isNotNull(),
        F.col("order_status").isin(STATUSES),
        F.col("customer_state").isin(STATES),
        F.col("quantity") > 0,
        F.col("total_price") > 0,
        F.col("event_ts").isNotNull(),
    )
    return dict(zip(QC_FLAGS, rules))


def all_rules_hold() -> Column:
    """Three-valued conjunction of the rules: TRUE, FALSE or NULL."""
    return reduce(and_, quality_rules().values())


def with_quality_flags(events: DataFrame) -> DataFrame:
    """Add the six flags and ``is_valid``.

    The flags keep their NULLs. ``is_valid`` does not: a row that cannot be
    shown to be good is not valid, so that the split below loses no row.
    """
    return events.withColumns(
        {**quality_rules(), "is_valid": F.coalesce(all_rules_hold(), F.lit(False))}
    )


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("is_valid"))


def quarantined_rows(checked: DataFrame) -> DataFrame:
    return checked.where(~F.col("is_valid"))


def three_valued_counts(events: DataFrame) -> DataFrame:
    """How many rows the plain conjunction calls true, false and neither."""
    verdict = F.coalesce(all_rules_hold().cast("string"), F.lit("unknown"))
    return events.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("records"))


def rejection_reasons(quarantine: DataFrame) -> DataFrame:
    """Rows per combination of flags."""
    return quarantine.groupBy(*QC_FLAGS).agg(F.count("*").alias("records"))


def batch_quality(checked: DataFrame, *by: str, key: str = "order_id") -> DataFrame:
    """Row counts and percentages in one aggregate pass.

    What de-duplication keeps is one row per key among the valid rows, so it
    is a distinct count; the rows themselves need not be ranked for it.
    """
    counts = checked.groupBy(*by).agg(
        F.count("*").alias("total_records"),
        F.count_if("is_valid").alias("valid_records"),
        F.countDistinct(F.when(F.col("is_valid"), F.col(key))).alias("silver_records"),
    )
    return with_shares(counts)


def with_shares(counts: DataFrame) -> DataFrame:
    """Differences and percentages of total, valid and silver counts."""
    counts = counts.withColumns({
        "quarantine_records": F.col("total_records") - F.col("valid_records"),
        "duplicates_removed": F.col("valid_records") - F.col("silver_records"),
    })
    return counts.withColumns({
        "valid_pct": percent(F.col("valid_records"), F.col("total_records")),
        "quarantine_pct": percent(F.col("quarantine_records"), F.col("total_records")),
        "dedup_pct": percent(F.col("duplicates_removed"), F.col("valid_records")),
    })


CUMULATIVE = {
    "cumulative_total": "total_records",
    "cumulative_valid": "valid_records",
    "cumulative_quarantine": "quarantine_records",
    "cumulative_silver": "silver_records",
    "cumulative_dedup": "duplicates_removed",
}


def with_running_totals(metrics: DataFrame, batch: str = "batch_id", *by: str) -> DataFrame:
    """Counters since the first batch, from stored metrics instead of driver memory.

    ``metrics`` holds one row per batch, so a window over all of it is small;
    ``by`` keeps several writers apart.
    """
    so_far = (
        Window.partitionBy(*by).orderBy(batch)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = {name: F.sum(source).over(so_far) for name, source in CUMULATIVE.items()}
    return metrics.withColumns({**running, "cumulative_batches": F.count("*").over(so_far)})
