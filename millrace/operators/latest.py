"""One row per key: the newest one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(event_time: str, *later: str, ties: Sequence[str] = ()) -> list[Column]:
    """A total order: newest event first, missing times last, then ``later``
    columns descending, then ``ties`` ascending so that equal times are settled."""
    return [
        *(F.col(name).desc_nulls_last() for name in (event_time, *later)),
        *(F.col(name).asc_nulls_first() for name in ties),
    ]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Spark cuts to one row per key before the shuffle (``WindowGroupLimit``),
    so each task sends at most one row of a key, however frequent the key is.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.select("*", place.alias("_place")).where("_place = 1").drop("_place")
