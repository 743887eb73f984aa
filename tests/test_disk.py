"""What a load leaves on disk, and what it moves there and back."""

import time

from pyspark.sql import functions as F

from millrace.checks import inputs as given
from millrace.checks import queries
from millrace.operators import layout
from millrace.schema import COMPRESSION
from millrace.sources.envelope import append_envelope_batch
from millrace.streaming.medallion import BatchWriter, Layers, write_layer

SMALL = "/root/testdata/sf0.001"


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in files.getAllFiles().mkString("\n").splitlines() if "/shuffle_" in name}


def left(spark, before):
    """Shuffle files that are new since ``before`` and stay."""
    for _ in range(50):
        new = shuffle_files(spark) - before
        if not new:
            break
        time.sleep(0.1)
    return new


def events(spark, n=3000):
    """Messages of ``n`` events of a third as many orders."""
    order = (F.col("id") % (n // 3)).cast("string")
    text = F.to_json(F.struct(
        order.alias("order_id"), F.lit(1).alias("quantity"), F.lit(5.0).alias("total_price"),
        F.lit("created").alias("order_status"),
        F.element_at(F.array(F.lit("SP"), F.lit("RJ")), (F.col("id") % 2 + 1).cast("int"))
        .alias("customer_state"),
        F.concat(F.lit("2024-01-01T00:"), F.lpad((F.col("id") * 7919 % 60).cast("string"), 2, "0"),
                 F.lit(":00Z")).alias("event_time"),
        F.sha2(F.col("id").cast("string"), 256).substr(1, 12).alias("customer_id")))
    return spark.range(n).select(
        order.alias("key"), text.alias("value"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("timestamp"))


def test_loads_leave_no_shuffle_files(spark, tmp_path):
    before, layers = shuffle_files(spark), Layers(str(tmp_path / "lake"))
    append_envelope_batch(events(spark), str(tmp_path / "wire"), 3)
    assert not left(spark, before)
    batch = queries.parse_events(spark.read.parquet(str(tmp_path / "wire")))
    BatchWriter(layers, "q")(batch, 0)
    assert not left(spark, before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert spark.read.parquet(layers.silver).count() == 1000


def test_batches_leave_no_shuffle_files(spark, tmp_path):
    append_envelope_batch(events(spark), str(tmp_path / "wire"), None)
    batch = queries.parse_events(spark.read.parquet(str(tmp_path / "wire")))
    before = shuffle_files(spark)
    BatchWriter(Layers(str(tmp_path / "lake")), "q", rebalance=False)(batch, 0)
    assert not left(spark, before)


def test_messages_are_stored_smaller(spark, tmp_path):
    size = lambda path: sum(f.stat().st_size for f in path.glob("*.parquet"))
    messages = queries._messages(spark, SMALL).coalesce(1)
    append_envelope_batch(messages, str(tmp_path / "wire"), None)
    wire = spark.read.parquet(str(tmp_path / "wire"))
    wire.write.parquet(str(tmp_path / "plain"), compression=COMPRESSION)
    assert size(tmp_path / "wire") < 0.9 * size(tmp_path / "plain")


def test_a_batch_of_a_large_table_is_replayed_as_it_was_loaded(spark, rows, tmp_path, monkeypatch):
    """Its rows are written where they are read: a state has a file of each task, not one."""
    want = rows(queries.REGISTRY["stream_restart_no_duplicates"](spark, SMALL))
    monkeypatch.setattr(given, "LARGE_BYTES", 0)
    monkeypatch.setattr(queries, "scratch_dir", lambda _, label: str(tmp_path / label))
    splits = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert rows(queries.REGISTRY["stream_restart_no_duplicates"](spark, SMALL)) == want and want
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == splits
    replayed = spark.read.parquet(f"{Layers(str(tmp_path / 'lake')).bronze}/query=replay/batch_id=1")
    files = replayed.groupBy("customer_state").agg(F.countDistinct("_metadata.file_path").alias("n"))
    assert files.agg(F.max("n")).first()[0] > 1


def test_items_move_without_what_is_made_of_them(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        text = given.order_events(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    above = text.split("FileScan")[0]
    assert "delivered" in above and "l_shipdate" not in above.split("Exchange hashpartitioning(l_partkey")[0]


def test_a_large_layer_is_put_in_place_once(spark, rows, tmp_path, monkeypatch):
    """By the rewrite alone: the layer before it lies where its rows were made, in a file of each task."""
    want = rows(queries.REGISTRY["layout_rewrite_preserves_rows"](spark, SMALL))
    monkeypatch.setattr(given, "LARGE_BYTES", 0)
    monkeypatch.setattr(queries, "scratch_dir", lambda _, label: str(tmp_path / label))
    assert rows(queries.REGISTRY["layout_rewrite_preserves_rows"](spark, SMALL)) == want and want
    layer = spark.read.parquet(str(tmp_path / "unclustered"))
    files = layer.groupBy("customer_state").agg(F.countDistinct("_metadata.file_path").alias("n"))
    assert files.agg(F.max("n")).first()[0] > 1


def test_layers_leave_no_shuffle_files(spark, tmp_path):
    rows = spark.range(2000).select(
        "id", F.timestamp_seconds("id").alias("event_ts"), F.lit("SP").alias("customer_state"))
    before = shuffle_files(spark)
    write_layer(rows, str(tmp_path / "layer"), "customer_state")
    layer = spark.read.parquet(str(tmp_path / "layer"))
    size = 3 * layout.TARGET_FILE_BYTES
    layout.rewrite(layer, str(tmp_path / "clustered"), "customer_state", ties=("id",), size_bytes=size)
    assert not left(spark, before)
    assert spark.read.parquet(str(tmp_path / "clustered")).count() == 2000
