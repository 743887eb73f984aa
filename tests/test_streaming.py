import json

import pytest
from pyspark.sql import functions as F

from millrace import cli
from millrace.operators.parse import parse_events
from millrace.operators.versions import snapshot
from millrace.schema import BRONZE_COLUMNS, QUARANTINE_COLUMNS, SILVER_COLUMNS
from millrace.sources import changelog
from millrace.sources.envelope import append_envelope_batch, file_stream
from millrace.streaming import console, late
from millrace.streaming.medallion import (
    SILVER_VERSIONING, STATE, BatchWriter, Layers, start_ingest, stored_metrics,
)


def event(order, hour, **changes):
    return {"order_id": order, "quantity": 1, "total_price": 5.0, "order_status": "created",
            "customer_state": "SP", "event_time": f"2024-01-01T{hour:02d}:00:00Z", **changes}


ARRIVALS = [
    [event("a", 1), event("a", 2, order_status="shipped"), event("b", 5),
     event("c", 1, quantity=0), event("d", 1, customer_state="")],
    [event("a", 1, order_status="confirmed"), event("b", 6, customer_state="RJ"),
     event("e", 1, order_status=None), "broken"],
    [event("f", 1), event("b", 5, order_status="cancelled")],
]


def send(spark, path, number):
    rows = [(str(i), e if isinstance(e, str) else json.dumps(e), number, i, None)
            for i, e in enumerate(ARRIVALS[number])]
    messages = spark.createDataFrame(
        rows, "key string, value string, partition int, offset long, timestamp timestamp")
    append_envelope_batch(messages.withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000 + number))),
                          path, 1)


def run(spark, path, layers, checkpoint, versioned):
    start_ingest(file_stream(spark, path, 1), layers, checkpoint, "q", versioned,
                 every=None).awaitTermination()


@pytest.fixture(params=[False, True], ids=["append", "versioned"])
def lake(request, spark, tmp_path):
    versioned = request.param
    path, checkpoint = str(tmp_path / "wire"), str(tmp_path / "checkpoint")
    layers = Layers(str(tmp_path / "lake"))
    for number in (0, 1):
        send(spark, path, number)
    run(spark, path, layers, checkpoint, versioned)
    # A new query goes on where the old one stopped.
    send(spark, path, 2)
    run(spark, path, layers, checkpoint, versioned)
    return layers, path, versioned, str(tmp_path / "lake")


def check(spark, layers, versioned):
    bronze = spark.read.parquet(layers.bronze)
    assert set(BRONZE_COLUMNS) <= set(bronze.columns)
    assert {r.batch_id: r["count"] for r in bronze.groupBy("batch_id").count().collect()} == {
        0: 5, 1: 4, 2: 2}
    quarantine = spark.read.parquet(layers.quarantine)
    assert set(QUARANTINE_COLUMNS) <= set(quarantine.columns)
    rejected = {r.order_id: r for r in quarantine.collect()}
    assert set(rejected) == {"c", "d", "e", None}
    # A blank state breaks the rule; a missing one leaves it open.
    assert rejected["d"].qc_valid_state is False and rejected["d"].customer_state == ""
    assert rejected[None].qc_valid_state is None and rejected[None].json_str == "broken"
    assert rejected["e"].qc_valid_status is None
    if versioned:
        silver = changelog.current(spark, layers.silver_versions, SILVER_VERSIONING)
        state = {r.order_id: (r.order_status, r.customer_state, r._commit_time)
                 for r in silver.collect()}
        # Older events that came late did not win.
        assert state == {"a": ("shipped", "SP", 1000), "b": ("created", "RJ", 2000),
                         "f": ("created", "SP", 3000)}
    else:
        silver = spark.read.parquet(layers.silver)
        assert set(SILVER_COLUMNS) <= set(silver.columns)
        assert sorted((r.batch_id, r.order_id, r.order_status) for r in silver.collect()) == [
            (0, "a", "shipped"), (0, "b", "created"), (1, "a", "confirmed"), (1, "b", "created"),
            (2, "b", "cancelled"), (2, "f", "created")]
    metrics = {r.batch_id: r for r in stored_metrics(spark, layers).collect()}
    assert [metrics[i].total_records for i in range(3)] == [5, 4, 2]
    assert (metrics[0].valid_records, metrics[0].silver_records) == (3, 2)
    assert (metrics[2].cumulative_total, metrics[2].cumulative_quarantine) == (11, 4)
    assert all(m.query == "q" and m.batch_duration_sec > 0 for m in metrics.values())
    # The records themselves hold their batch and the counters.
    lines = [json.loads(r.value) for r in spark.read.text(layers.metrics).collect()]
    assert {(r["batch_id"], r["cumulative_total"], r["cumulative_batches"]) for r in lines} == {
        ("0", "5", "1"), ("1", "9", "2"), ("2", "11", "3")}


def test_layers_after_restart_and_replay(spark, lake, capsys):
    layers, path, versioned, root = lake
    check(spark, layers, versioned)
    again = spark.read.parquet(path).where("partition = 1")
    BatchWriter(layers, "q", versioned)(parse_events(again), 1)
    check(spark, layers, versioned)
    # An empty batch leaves no trace.
    BatchWriter(layers, "q", versioned)(parse_events(again.where("false")), 9)
    check(spark, layers, versioned)

    cli.main(["dashboard", "--root", root], spark)
    cli.main(["gold", "--root", root, "--database", f"lake_{versioned}"], spark)
    cli.main(["analytics", "--database", f"lake_{versioned}"], spark)
    cli.main(["analytics", "--root", root, "--report", "top_categories"], spark)
    assert "pct_of_total" in capsys.readouterr().out
    if versioned:
        cli.main(["versions", "--root", root], spark)
        cli.main(["evolve", "--root", root], spark)
        assert "no delivered order" in capsys.readouterr().out
        log = changelog.read_log(spark, layers.silver_versions, SILVER_VERSIONING)
        delivered = log.where("order_id = 'f'").withColumn("order_status", F.lit("delivered"))
        changelog.write_commit(delivered, layers.silver_versions, SILVER_VERSIONING, 3001, STATE)
        cli.main(["evolve", "--root", root], spark)
        assert "review_score" in capsys.readouterr().out
        cli.main(["evolve", "--root", root], spark)
        assert "there already" in capsys.readouterr().out
        cli.main(["maintain", "--root", root, "--keep", "2"], spark)
        printed = capsys.readouterr().out
        assert "dropped commits" in printed and "gold_status_funnel" in printed
        cli.main(["maintain", "--root", root, "--table", "orders_silver",
                  "--operation", "compact"], spark)
        cli.main(["maintain", "--root", root + "/none", "--table", "gold_state_metrics"], spark)
        assert "not built yet" in capsys.readouterr().out
        table = changelog.current(spark, layers.silver_versions, SILVER_VERSIONING)
        assert table.count() == 3


def test_stream_equals_batch_upsert(spark, rows, tmp_path):
    path, layers = str(tmp_path / "wire"), Layers(str(tmp_path / "lake"))
    for number in range(3):
        send(spark, path, number)
    run(spark, path, layers, str(tmp_path / "cp"), True)
    log = changelog.read_log(spark, layers.silver_versions, SILVER_VERSIONING)
    columns = ["order_id", "order_status", "event_ts", STATE]
    got = changelog.current(spark, layers.silver_versions, SILVER_VERSIONING)
    assert rows(got.select(columns)) == rows(snapshot(log, SILVER_VERSIONING).select(columns))


def test_console_views(spark, tmp_path):
    path = str(tmp_path / "wire")
    for number in range(3):
        send(spark, path, number)
    valid, rejected = console.console_views(spark.read.parquet(path))
    assert (len(valid.columns), len(rejected.columns)) == (10, 8)
    assert (valid.count(), rejected.count()) == (7, 4)
    queries = console.start_console(file_stream(spark, path, 1), every="1 second")
    try:
        for query in queries:
            query.processAllAvailable()
        assert [q.name for q in queries] == ["valid-view", "quarantine-view"]
        assert all(q.exception() is None for q in queries)
    finally:
        for query in queries:
            query.stop()


def test_dedup_within_watermark(spark, tmp_path):
    path = str(tmp_path / "wire")
    for number in range(3):
        send(spark, path, number)
    parsed = parse_events(file_stream(spark, path, 1)).where("order_id IS NOT NULL")
    query = (
        late.dedup_within_watermark(parsed, ["order_id"]).writeStream.format("memory")
        .queryName("unique_orders").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = [r.order_id for r in spark.table("unique_orders").collect()]
    assert sorted(got) == ["a", "b", "c", "d", "e", "f"]


def test_first_sightings_behind_the_watermark_are_kept(spark, tmp_path):
    """Late by more than an hour: a new key, a repeat, and one exactly at the watermark."""
    path, root, hour = str(tmp_path / "wire"), str(tmp_path / "late"), 3600
    batches = [[("a", 0), ("a", 5), ("b", None)], [("a", 9 * hour), ("c", 8 * hour)],
               [("d", 7 * hour), ("a", hour), ("e", 8 * hour), ("f", 8 * hour + 1), ("c", 9 * hour)],
               [("d", 9 * hour), ("g", 0), ("g", 0)]]
    for number, rows in enumerate(batches):
        spark.createDataFrame(
            [(k, None if t is None else 1_700_000_000 + t) for k, t in rows], "k string, s long"
        ).select("k", F.timestamp_seconds("s").alias("t")).coalesce(1).write.mode("append").parquet(path)
    events = spark.readStream.schema("k string, t timestamp").option(
        "maxFilesPerTrigger", 1).parquet(path)
    late.split_late(events, root, "t").option("checkpointLocation", str(tmp_path / "cp1")).trigger(
        availableNow=True).start().awaitTermination()
    side = [r.k for r in late.late_rows(spark, root, events.schema).collect()]
    assert sorted(side) == ["a", "d", "e", "g", "g"]
    query = late.unique_on_time(spark, root, events.schema, ["k"]).writeStream.format(
        "memory").queryName("unique_on_time").option(
        "checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = [r.k for r in spark.table("unique_on_time").collect()]
    assert sorted(got) == ["a", "b", "c", "d", "f"]


def test_late_side_output_equals_sql(spark):
    import duckdb
    from check_oracle import compare
    from millrace.checks.oracle import ORACLE
    from millrace.checks.queries import REGISTRY
    folder, db = "/root/testdata/sf0.001", duckdb.connect()
    for table in ("lineitem", "orders", "customer", "part"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    name = "stream_late_side_output"
    assert ", true" in str(db.execute(ORACLE[name]).fetchall()).replace("'", "")
    line = compare(spark, db, name, REGISTRY[name], ORACLE[name], folder)
    assert line.startswith("equal"), line


def test_second_checkpoint_cannot_replace_batches(spark, tmp_path):
    path, layers = str(tmp_path / "wire"), Layers(str(tmp_path / "lake"))
    send(spark, path, 0)
    run(spark, path, layers, str(tmp_path / "cp1"), True)
    for query, first in (("q", 0), ("other", 0)):
        with pytest.raises(ValueError):
            start_ingest(file_stream(spark, path, 1), layers, str(tmp_path / "cp2"), query,
                         True, every=None, first_commit=first)
    start_ingest(file_stream(spark, path, 1), layers, str(tmp_path / "cp2"), "other",
                 True, every=None, first_commit=1000).awaitTermination()
    assert changelog.commits(spark, layers.silver_versions, SILVER_VERSIONING) == [1000, 2000]
