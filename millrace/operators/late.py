"""Rows that arrive behind the watermark, told apart instead of lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def behind(event_time: Column | str, watermark: Column) -> Column:
    """Whether a row is behind the watermark; a row at it is, one without a time is not."""
    time = F.col(event_time) if isinstance(event_time, str) else event_time
    return F.coalesce(time <= watermark, F.lit(False))


def with_lateness(events: DataFrame, batch: str, event_time: str, allowed: str) -> DataFrame:
    """Add the watermark of each row's batch and whether the row is behind it.

    As in a stream, the watermark of a batch is the greatest event time of all
    earlier batches minus ``allowed``, and a row at the watermark is behind it
    too; the first batch has none. Times are
    reduced to one per batch first, so the running maximum and the join back
    handle one row per batch, not per event.
    """
    newest = events.groupBy(batch).agg(F.max(event_time).alias("_newest"))
    earlier = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    marks = newest.select(
        batch, (F.max("_newest").over(earlier) - F.expr(f"INTERVAL {allowed}")).alias("watermark")
    )
    return events.join(marks, batch, "left").withColumn(
        "is_late", behind(event_time, F.col("watermark")))


def split_late(events: DataFrame, batch: str, event_time: str, allowed: str = "1 hour"):
    """``(on time, late)``; together they are all rows."""
    marked = with_lateness(events, batch, event_time, allowed)
    return marked.where(~F.col("is_late")), marked.where("is_late")
