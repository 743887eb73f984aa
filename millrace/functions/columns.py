"""Scalar expressions on the fields of an order event."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schema import (
    DELIVERY_TIME_FORMAT, EVENT_TIME_FORMAT, PROCESSING_TIME_FORMAT,
    RAW_STATUS_TO_STATUS,
)


def blank_to_null(column: Column | str) -> Column:
    """CSV blanks arrive as empty strings; treat them as missing."""
    column = F.col(column) if isinstance(column, str) else column
    return F.nullif(column, F.lit(""))


def parse_event_time(column: Column | str) -> Column:
    return F.try_to_timestamp(blank_to_null(column), F.lit(EVENT_TIME_FORMAT))


def parse_processing_time(column: Column | str) -> Column:
    return F.try_to_timestamp(blank_to_null(column), F.lit(PROCESSING_TIME_FORMAT))


def format_event_time(column: Column | str) -> Column:
    return F.date_format(column, EVENT_TIME_FORMAT)


def shop_time_to_event_time(column: Column | str) -> Column:
    """``2017-10-02 10:56:33`` becomes ``2017-10-02T10:56:33Z``."""
    return F.concat(F.replace(column, F.lit(" "), F.lit("T")), F.lit("Z"))


def time_of(df: DataFrame, name: str) -> Column:
    """A delivery time as a timestamp; the layers keep it as text."""
    if df.schema[name].dataType.typeName() in ("string", "varchar", "char"):
        return F.try_to_timestamp(blank_to_null(name), F.lit(DELIVERY_TIME_FORMAT))
    return F.col(name).cast("timestamp")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds, NULL unless both times exist."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def normalize_status(column: Column | str) -> Column:
    """Shop status to contract status; an unknown one passes through."""
    column = F.col(column) if isinstance(column, str) else column
    mapping = F.create_map(*map(F.lit, chain.from_iterable(RAW_STATUS_TO_STATUS.items())))
    return F.coalesce(F.try_element_at(mapping, column), column)
