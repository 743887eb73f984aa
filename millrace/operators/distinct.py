"""Exact distinct counts that add up over days and batches.

The keys of a group are bits: one bitmap of 32,768 bits per bucket of an integer key. Bitmaps of
parts are combined by OR, so a count over a week comes from seven stored days and
no row is read again. Good for keys that lie dense, as counters do; sparse keys take a bitmap each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_bitmaps(rows: DataFrame, key: str, *by: str | Column) -> DataFrame:
    """``by``, ``bucket``, ``bitmap``: the keys of each group; NULL keys are left out."""
    return rows.where(F.col(key).isNotNull()).groupBy(
        *by, F.bitmap_bucket_number(key).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of coarser groups, or of several tables put together."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_keys(bitmaps: DataFrame, *by: str) -> DataFrame:
    """``by``, ``distinct_keys`` over bitmaps that may repeat a group and bucket."""
    return merged_bitmaps(bitmaps, *by).groupBy(*by).agg(
        F.sum(F.bitmap_count("bitmap")).alias("distinct_keys"))


def rolling_bitmaps(daily: DataFrame, day: str, days: int) -> DataFrame:
    """For each day that has bitmaps, those of the ``days`` days up to it."""
    ends = daily.select(F.col(day).alias("_end")).distinct()
    reach = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    spread = daily.select("*", reach.alias("_ahead")).withColumn(
        "_end", F.date_add(day, F.col("_ahead"))).drop(day, "_ahead")
    return merged_bitmaps(spread.join(ends, "_end"), "_end").withColumnRenamed("_end", day)
