"""Two live views of the stream: good rows and quarantined rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.operators.parse import parse_events
from millrace.operators.quality import quarantined_rows, valid_rows, with_quality_flags
from millrace.schema import CONSOLE_QUARANTINE_COLUMNS, CONSOLE_VALID_COLUMNS


def console_views(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantined)`` as the console shows them."""
    checked = with_quality_flags(parse_events(raw))
    return (
        valid_rows(checked).select(CONSOLE_VALID_COLUMNS),
        quarantined_rows(checked).select(CONSOLE_QUARANTINE_COLUMNS),
    )


def start_console(raw: DataFrame, every: str = "10 seconds") -> list[StreamingQuery]:
    """Both views as concurrent queries; await them with ``spark.streams``."""
    valid, quarantined = console_views(raw)
    return [
        _to_console(valid, rows=20).queryName("valid-view").trigger(processingTime=every).start(),
        _to_console(quarantined, rows=10).queryName("quarantine-view")
        .trigger(processingTime=every).start(),
    ]


def progress_rows(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """``query``, ``batch_id``, ``input_rows`` of the batches that the queries still remember; a
    batch without rows is none."""
    seen = {(query.name, p["batchId"]): p["numInputRows"]
            for query in queries for p in query.recentProgress if p["numInputRows"]}
    return spark.createDataFrame(
        [(name, batch, rows) for (name, batch), rows in sorted(seen.items())],
        "query string, batch_id bigint, input_rows bigint")


def _to_console(view: DataFrame, rows: int) -> DataStreamWriter:
    return (
        view.writeStream.outputMode("append").format("console")
        .options(truncate="false", numRows=rows)
    )
