"""Checks and statistics on the layers and the versioned table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.measures import percent
from millrace.operators.versions import (
    Versioning, as_of, owning_commits, snapshot, surviving_commits,
)


def duplicate_audit(layers: Mapping[str, DataFrame], key: str = "order_id") -> DataFrame:
    """Rows, distinct keys and surplus rows per layer, one pass each."""
    audits = [
        rows.agg(
            F.lit(name).alias("layer"),
            F.count("*").alias("total_rows"),
            F.countDistinct(key).alias("unique_keys"),
        )
        for name, rows in layers.items()
    ]
    united = audits[0]
    for audit in audits[1:]:
        united = united.unionByName(audit)
    # A row without a key is a surplus row too: a distinct count leaves it out.
    surplus = F.col("total_rows") - F.col("unique_keys")
    return united.withColumn("duplicate_rows", surplus).withColumn(
        "duplicate_pct", percent(surplus, F.col("total_rows"))
    )


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        rows.agg(F.lit(name).alias("layer"), F.count("*").alias("records"))
        for name, rows in layers.items()
    ]
    united = counts[0]
    for count in counts[1:]:
        united = united.unionByName(count)
    return united


def multi_version_keys(rows: DataFrame, key: str = "order_id") -> DataFrame:
    """Keys with more than one row, and how many."""
    return rows.groupBy(key).agg(F.count("*").alias("versions")).where("versions > 1")


def most_updated_key(rows: DataFrame, key: str = "order_id") -> DataFrame:
    return multi_version_keys(rows, key).orderBy(F.col("versions").desc(), key).limit(1)


def version_history(
    rows: DataFrame, v: Versioning, columns: Sequence[str]
) -> DataFrame:
    """All versions of every key that has several, beside the winning version.

    Winners carry the number of versions, so the versions join one row per key;
    a key with very many versions is split by Spark's skew join.
    """
    (key,) = v.keys
    winners = snapshot(rows, v).select(key, *(F.col(c).alias(f"current_{c}") for c in columns))
    wanted = winners.join(multi_version_keys(rows, key), key)
    return rows.select(key, *columns).join(wanted, key)


def versions_of(rows: DataFrame, key: str, value, order: Sequence[str]) -> DataFrame:
    """All versions of one key; the filter reaches the scan."""
    return rows.where(F.col(key) == value).orderBy(*order)


def time_travel_growth(log: DataFrame, v: Versioning) -> DataFrame:
    """Table size at the first and at the last commit that still owns a row.

    A key is in the table from its first commit on, so both sizes count keys.
    Keys are grouped by their first commit, so the windows run over one row per
    commit.
    """
    groups = owning_commits(log, v).groupBy("first_commit").agg(
        F.count("*").alias("_n"), F.min("owner").alias("_early"), F.max("owner").alias("_late"))
    bounds = groups.select(
        "first_commit", "_n",
        F.min("_early").over(Window.partitionBy()).alias("early_commit"),
        F.max("_late").over(Window.partitionBy()).alias("late_commit"),
    )
    sizes = bounds.groupBy("early_commit", "late_commit").agg(
        F.sum(F.when(F.col("first_commit") <= F.col("early_commit"), F.col("_n")))
        .alias("early_records"),
        F.sum(F.when(F.col("first_commit") <= F.col("late_commit"), F.col("_n")))
        .alias("late_records"),
    )
    return sizes.withColumn("growth", F.col("late_records") - F.col("early_records"))


def status_distribution(log: DataFrame, v: Versioning, commit, status: str) -> DataFrame:
    """Rows per status in the table as of ``commit``."""
    return as_of(log, v, commit).groupBy(status).agg(F.count("*").alias("records"))


def incremental_reduction(log: DataFrame, v: Versioning) -> DataFrame:
    """How many rows fewer an incremental read since the first surviving commit
    returns than a read of the snapshot."""
    groups = surviving_commits(log, v)
    first = F.min(v.commit).over(Window.partitionBy())
    marked = groups.select("records", (F.col(v.commit) > first).alias("_changed"))
    counts = marked.agg(
        F.sum("records").alias("full_records"),
        F.coalesce(F.sum(F.when(F.col("_changed"), F.col("records"))), F.lit(0))
        .alias("incremental_records"),
    )
    saved = F.col("full_records") - F.col("incremental_records")
    return counts.withColumn("reduction_pct", percent(saved, F.col("full_records"), 1))


def table_stats(current: DataFrame, v: Versioning, partition: str) -> DataFrame:
    """Rows, partitions, commits and the latest commit of a table in one pass."""
    return current.groupBy(partition, v.commit).agg(F.count("*").alias("_n")).agg(
        F.sum("_n").alias("total_rows"),
        F.countDistinct(partition).alias("partitions"),
        F.countDistinct(v.commit).alias("commits"),
        F.max(v.commit).alias("latest_commit"),
    )


def file_counts(table: DataFrame) -> DataFrame:
    """Rows and data files of a table that is read straight from files."""
    return table.groupBy(F.col("_metadata.file_path").alias("_file")).agg(
        F.count("*").alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("records"), F.count("_file").alias("files"))


def partition_row_counts(current: DataFrame, partition: str, top: int | None = None) -> DataFrame:
    counts = current.groupBy(partition).agg(F.count("*").alias("records"))
    ordered = counts.orderBy(F.col("records").desc(), partition)
    return ordered if top is None else ordered.limit(top)


def latest_rows(rows: DataFrame, order: Sequence, columns: Sequence[str], n: int = 10) -> DataFrame:
    """A top-n sample; Spark keeps n rows per task, not a sorted table."""
    return rows.orderBy(*order).limit(n).select(*columns)
