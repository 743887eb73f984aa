"""Row numbers over a whole table, without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch_dir

_IN_PARTITION = (1 << 33) - 1


def numbered(rows: DataFrame, *order: str, column: str = "row_number") -> DataFrame:
    """``rows`` with their number, from 1, in the order of ``order``.

    Rows are cut into ranges, sorted there and written with their place in the range; a
    range's offset is the number of rows in those before it. Equal rows share no number.
    """
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, "numbered")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)).alias("_place"),
    ).write.parquet(path, compression="zstd")
    placed = spark.read.parquet(path)
    # One row per range.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return placed.join(offsets, "_part").withColumn(
        column, F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before")
