"""Bulk loads: rows are written where they are read, with the results of small batches."""

import pytest
from pyspark.sql import functions as F

from millrace.checks import inputs as given
from millrace.checks import queries
from millrace.sources import changelog
from millrace.sources.envelope import append_envelope_batch, file_stream
from millrace.streaming.medallion import (
    SILVER_VERSIONING, STREAM_VERSIONING, Layers, start_ingest,
)

SMALL = "/root/testdata/sf0.001"


def files_of_states(spark, folder):
    """The most files that a state has."""
    files = spark.read.parquet(folder).groupBy("customer_state").agg(
        F.countDistinct("_metadata.file_path").alias("n"))
    return files.agg(F.max("n")).first()[0]


@pytest.mark.parametrize("versioned", [False, True])
def test_no_layer_is_rebalanced(spark, rows, tmp_path, versioned):
    path = str(tmp_path / "wire")
    append_envelope_batch(queries._messages(spark, SMALL), path, 3)
    found = {}
    for rebalance in (True, False):
        layers = Layers(str(tmp_path / f"lake-{rebalance}"))
        start_ingest(file_stream(spark, path, 3), layers, f"{tmp_path}/cp-{rebalance}", "q", versioned,
                     every=None, rebalance=rebalance).awaitTermination()
        assert files_of_states(spark, layers.bronze) == (1 if rebalance else 3)
        silver = layers.silver_versions if versioned else layers.silver
        found[rebalance] = [
            rows(spark.read.parquet(layer).drop("ingestion_ts"))
            for layer in (layers.bronze, layers.quarantine, silver)]
        if versioned:
            # The stream's commits hold one row per order: no tie is left to settle.
            assert rows(changelog.current(spark, silver, STREAM_VERSIONING)) == rows(
                changelog.current(spark, silver, SILVER_VERSIONING))
    assert found[True] == found[False]


@pytest.mark.parametrize("name", [
    "stream_medallion_pipeline", "stream_metrics", "stream_upsert", "stream_watermark_dedup"])
def test_large_tables_give_the_same_results(spark, rows, monkeypatch, name):
    splits = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = rows(queries.REGISTRY[name](spark, SMALL))
    monkeypatch.setattr(given, "LARGE_BYTES", 0)
    assert rows(queries.REGISTRY[name](spark, SMALL)) == want and want
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == splits
