"""Tables by name in the session's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.schema import COMPRESSION, DEFAULT_DATABASE


def ensure_database(
    spark: SparkSession, database: str = DEFAULT_DATABASE, location: str | None = None
) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def register(
    df: DataFrame, table: str, database: str = DEFAULT_DATABASE, path: str | None = None
) -> None:
    """Write a table and make it known; a table of that name is replaced."""
    writer = df.write.mode("overwrite").format("parquet").option("compression", COMPRESSION)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(f"{database}.{table}")


def register_bucketed(
    df: DataFrame, table: str, key: str, buckets: int,
    database: str = DEFAULT_DATABASE, path: str | None = None,
) -> None:
    """Like ``register``, with the rows cut by a hash of ``key``. Grouping by the
    key or by more than the key, joining on it and merging into the table then
    read each bucket where it lies, without a shuffle. Repartitioning first
    makes one file per bucket instead of one per task and bucket."""
    writer = (
        df.repartition(buckets, key).write.mode("overwrite").format("parquet")
        .option("compression", COMPRESSION).bucketBy(buckets, key).sortBy(key)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(f"{database}.{table}")


def shuffle_width(spark: SparkSession) -> int:
    """The number of buckets that fits the session's other shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tables(spark: SparkSession, database: str = DEFAULT_DATABASE) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")
