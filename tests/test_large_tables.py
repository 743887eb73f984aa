"""What must not grow with the table: rows through one task, and exchanges of wide rows."""

from pyspark.sql import functions as F

from millrace.checks import inputs as given
from millrace.checks import queries
from millrace.operators.sizes import estimated_bytes

SMALL = "/root/testdata/sf0.001"


def test_newest_rows_need_no_exchange_after_the_joins(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        text = queries.silver(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert "WindowGroupLimit" in text.split("SortMergeJoin")[0]
    assert "Exchange" not in text.split("SortMergeJoin")[0]


def tasks_by_state(spark, path):
    """Per state the numbers of the tasks that wrote its files, one for each file."""
    files = spark.read.parquet(path).select(
        "customer_state", F.col("_metadata.file_path").alias("file")).distinct()
    task = F.regexp_extract("file", "part-([0-9]+)", 1)
    return {r.customer_state: sorted(r.tasks) for r in files.groupBy("customer_state").agg(
        F.collect_list(task).alias("tasks")).collect()}


def test_each_state_is_written_by_its_own_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_dir", lambda *_: str(tmp_path / "files"))
    assert {r.files for r in queries.REGISTRY["table_files"](spark, SMALL).collect()} == {1}
    tasks = tasks_by_state(spark, str(tmp_path / "files"))
    assert len({task for (task,) in tasks.values()}) == len(tasks) > 20


def test_texts_of_messages_are_not_dealt_out(spark, tmp_path):
    """An arrival lies in as many files as a batch of the stream takes, and no exchange moves text."""
    messages = queries._messages(spark, SMALL, 6).where("shuffled_batch_id <= 3")
    text = messages._jdf.queryExecution().executedPlan().toString()
    above, below = text.split("RoundRobinPartitioning(6)")
    assert "json" in above.lower() and "json" not in below.lower()
    queries._stage(spark, SMALL, str(tmp_path / "wire"), (0,))
    assert len(list((tmp_path / "wire").glob("part-*"))) == queries._batch_files(spark, SMALL)


def test_partitions_of_events_grow_with_a_large_table(spark, rows, monkeypatch):
    """Each has a bounded share of the items and all rows of its orders; small tables stay as they were."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert given.event_partitions(spark, SMALL) is None
    small = queries.REGISTRY["evolve_schema"](spark, SMALL)
    want = rows(small)
    assert "REPARTITION_BY_NUM" not in plan(small)
    monkeypatch.setattr(given, "LARGE_BYTES", 0)
    monkeypatch.setattr(given, "PARTITION_BYTES", 10_000)
    stored = estimated_bytes(given.table(spark, SMALL, "lineitem"))
    parts = given.event_partitions(spark, SMALL)
    assert parts == stored // 10_000 > 4
    events = given.order_events(spark, SMALL)
    assert events.rdd.getNumPartitions() == parts
    spread = events.select("order_id", F.spark_partition_id().alias("task")).groupBy(
        "order_id").agg(F.countDistinct("task").alias("n"))
    assert spread.agg(F.max("n")).first()[0] == 1
    large = queries.REGISTRY["evolve_schema"](spark, SMALL)
    assert rows(large) == want and "REPARTITION_BY_NUM" in plan(large)


def test_large_arrivals_are_dealt_out_by_their_joins(spark, tmp_path, monkeypatch):
    """As many files as a batch of the stream takes, an order's messages in one of them."""
    monkeypatch.setattr(given, "LARGE_BYTES", 0)
    text = queries._messages(spark, SMALL, 6)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in text
    queries._stage(spark, SMALL, str(tmp_path / "wire"), (0,))
    wire = spark.read.parquet(str(tmp_path / "wire"))
    assert len(list((tmp_path / "wire").glob("part-*"))) == queries._batch_files(spark, SMALL)
    files = wire.groupBy("key").agg(F.countDistinct("_metadata.file_path").alias("n"))
    assert files.agg(F.max("n")).first()[0] == 1
