"""Stateful de-duplication with a watermark that has an effect, and its late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.late import behind

_NEWEST = "newest timestamp"


def dedup_within_watermark(
    events: DataFrame, keys: list[str], event_time: str = "kafka_ts", delay: str = "1 hour"
) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of each other.

    State is one small entry per key and goes once the watermark has passed it.
    Rows behind the watermark are dropped too; put :func:`split_late` before it where
    they must not be lost.
    """
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def split_late(
    events: DataFrame, root: str, event_time: str = "kafka_ts", delay: str = "1 hour"
) -> DataStreamWriter:
    """A writer that keeps every row below ``root``, marked as ``operators.late`` does.

    The watermark of a micro-batch is the greatest event time of all earlier ones minus
    ``delay``. ``seen_at`` is that greatest time with the batch's own rows: it never
    goes back, so that no row is behind a watermark over it. A batch replaces its
    folders when it comes again; the greatest time goes from batch to batch in a file, read by its
    own folder. :func:`unique_on_time` may meet a replaced folder's rows twice: they carry the same keys
    and times, so its state or its watermark drops them.
    """
    spark = events.sparkSession
    spark.createDataFrame([(None,)], "newest timestamp").write.mode("overwrite").parquet(
        f"{root}/newest/micro_batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        at = lambda n: own.read.schema(_NEWEST).parquet(
            f"{root}/newest/micro_batch={n}").agg(F.max("newest").alias("newest"))
        newest = batch.agg(F.max(event_time).cast("timestamp").alias("newest"))
        newest.unionByName(at(number - 1)).agg(F.max("newest").alias("newest")).coalesce(
            1).write.mode("overwrite").parquet(f"{root}/newest/micro_batch={number}")
        known = at(number - 1).select(
            (F.col("newest") - F.expr(f"INTERVAL {delay}")).alias("_mark")
        ).crossJoin(at(number).select(
            F.coalesce("newest", F.timestamp_seconds(F.lit(0))).alias("seen_at")))
        batch.crossJoin(F.broadcast(known)).withColumn(
            "is_late", behind(event_time, F.col("_mark"))).drop("_mark").write.mode(
            "overwrite").partitionBy("is_late").parquet(f"{root}/marked/micro_batch={number}")

    return events.writeStream.foreachBatch(write)


def _marked(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("seen_at", T.TimestampType()),
                         T.StructField("micro_batch", T.LongType()),
                         T.StructField("is_late", T.BooleanType())])


def unique_on_time(
    spark: SparkSession, root: str, schema: T.StructType, keys: list[str], delay: str = "1 hour"
) -> DataFrame:
    """A stream of the first row of each key among the rows that :func:`split_late` found on
    time; a key comes again once the stream has gone on by ``delay``. None is dropped as late."""
    on_time = spark.readStream.schema(_marked(schema)).parquet(f"{root}/marked").where("NOT is_late")
    return dedup_within_watermark(on_time, keys, "seen_at", delay)


def late_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The side output: every row that came behind the watermark of its micro-batch."""
    return spark.read.schema(_marked(schema)).parquet(f"{root}/marked").where("is_late")
