"""Rewriting a layer into well-sized, time-sorted files."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.sizes import estimated_bytes
from millrace.schema import COMPRESSION
from millrace.session import shuffles_dropped

TARGET_FILE_BYTES = 128 * 1024 * 1024
SMALL_FILE_BYTES = 64 * 1024 * 1024


def clustered(
    df: DataFrame,
    partition: str,
    event_time: str = "event_ts",
    ties: Sequence[str] = (),
    size_bytes: int | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Rows cut into ranges of about one file each, sorted by time inside.

    Ranges run over partition, time and ``ties``: a partition that holds much
    of the table is cut by time, and many rows with one time by ``ties``. For
    rows that do not come straight from files, pass their size.
    """
    size = estimated_bytes(df) if size_bytes is None else size_bytes
    files = max(1, math.ceil(size / target_bytes))
    return (
        df.repartitionByRange(files, partition, event_time, *ties)
        .sortWithinPartitions(partition, event_time, *ties)
    )


def rewrite(df: DataFrame, path: str, partition: str, **layout) -> None:
    """Write ``df`` clustered. ``path`` must not be a folder ``df`` reads from."""
    writer = clustered(df, partition, **layout).write.mode("overwrite").partitionBy(partition)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path, compression=COMPRESSION)


def write_one_file_each(
    df: DataFrame, path: str, partition: str, values: Sequence[str], mode: str = "errorifexists"
) -> None:
    """Write ``df`` with one file in each partition's folder.

    Each of ``values`` is a task of its own, and one more takes what is none of them. A task
    keeps its files open side by side, so it need not sort its rows by the partition.
    """
    spark, tasks, writers = df.sparkSession, len(values) + 1, "spark.sql.maxConcurrentOutputFileWriters"
    place = F.coalesce(F.array_position(F.array(*map(F.lit, values)), F.col(partition)), F.lit(0))
    before = spark.conf.get(writers)
    spark.conf.set(writers, tasks)
    try:
        df.repartitionById(tasks, place.cast("int")).write.mode(mode).partitionBy(partition).parquet(path)
    finally:
        spark.conf.set(writers, before)


def partitions_of_small_files(
    table: DataFrame, partition: Sequence[str], small: int = SMALL_FILE_BYTES
) -> DataFrame:
    """Per partition that has more than one file below ``small``: how many, and all its ``files``. Reads
    no column but the partition's."""
    files = table.groupBy(
        *partition, F.col("_metadata.file_path").alias("_file")
    ).agg(F.max("_metadata.file_size").alias("_bytes"))
    return files.groupBy(*partition).agg(
        F.count_if(F.col("_bytes") < small).alias("small_files"),
        F.count(F.lit(1)).alias("files")).where("small_files > 1")


def compact(
    spark: SparkSession, path: str, partition: Sequence[str], small: int = SMALL_FILE_BYTES,
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Put the files of partitions with several small ones together, in place.

    Other partitions are neither read nor written: the write replaces the partitions it brings.
    With ``sort_by`` files are sorted inside. Returns the rewritten partitions, as they were.
    """
    table = spark.read.option("mergeSchema", True).parquet(path)
    touched = spark.createDataFrame(
        partitions_of_small_files(table, partition, small).collect(),
        table.select(*partition).schema.add("small_files", "long").add("files", "long"))
    if touched.isEmpty():
        return touched
    same = [table[name].eqNullSafe(touched[name]) for name in partition]
    rows = table.join(touched, same, "left_semi").hint("rebalance", *partition)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition, *sort_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition).parquet(path, compression=COMPRESSION)
    return touched
