"""Sizes of results before they are there."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a result's size; starts no job.

    For files it is their size on disk, for joins the product of the inputs, so it
    may be far off either way. Good for a number of files, not for a broadcast.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes()))
