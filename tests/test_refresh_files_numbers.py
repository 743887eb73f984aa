"""Gold from changes, mergeable distinct counts, numbering, file order, small files, late retries."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import distinct, enrich, layout, numbering, versions
from millrace.operators.versions import Versioning
from millrace.plans import gold, refresh, views
from millrace.sources import catalog
from millrace.sources.tables import exists, in_file_order
from millrace.streaming import late

V = Versioning(keys=("order_id",), event_time="event_ts", ties=("total_price",))
DDL = ("order_id string, customer_state string, order_status string, product_category string,"
       " quantity int, unit_price double, freight_value double, total_price double,"
       " event_ts timestamp, order_delivered_ts string, order_estimated_ts string, _commit_time long")


def order_log(n=160):
    rng, made = random.Random(5), []
    prices = [1.1, 2.35, 1e18, -4.0, None, float("nan"), float("inf"), 0.000001]
    for i in range(n):
        made.append((
            f"o{rng.randint(0, 39)}", rng.choice(["SP", "RJ", None]), rng.choice(["created", "shipped"]),
            rng.choice(["toys", "books", None]), rng.choice([1, 2, None]), rng.choice(prices[:4]), 2.5,
            prices[i % 8] if i % 20 == 0 else rng.choice(prices[:5]),
            None if i % 31 == 0 else dt.datetime(2024, 1, 1 + rng.randint(0, 3), rng.randint(0, 23), i % 60),
            rng.choice(["2024-01-05 00:00:00", "", None]), "2024-01-04 12:00:00", rng.randint(1, 6)))
    return made


@pytest.mark.parametrize("mode", ["daily", "state", "status", "category"])
def test_refreshed_gold_equals_the_full_one(spark, rows, tmp_path, mode):
    log = spark.createDataFrame(order_log(), DDL)
    table, full = refresh.tables()[mode], gold.GOLD_TABLES[mode][2]
    path = str(tmp_path / "parts")
    refresh.parts_of(refresh.first_rows(versions.as_of(log, V, 2)), table).write.parquet(path)
    now = spark.read.parquet(path)
    for step in ((2, 3), (3, 6)):
        now = refresh.refreshed(now, log, V, [step], table)
        want = full(versions.as_of(log, V, step[1]))
        got = table.finish(now)
        assert got.columns == want.columns
        assert rows(got) == rows(want)


def test_refresh_by_job(spark, tmp_path, capsys):
    from millrace import cli
    from millrace.sources import changelog
    from millrace.streaming.medallion import SILVER_VERSIONING, STATE, TIES, Layers
    root = str(tmp_path / "lake")
    log = spark.createDataFrame(order_log(), DDL)
    for name in TIES:
        if name not in log.columns:
            log = log.withColumn(name, F.lit(None).cast("string"))
    place = Layers(root).silver_versions
    for until in (3, 6):
        for commit in range(until - 2, until + 1):
            changelog.write_commit(log.where(F.col("_commit_time") == commit), place,
                                   SILVER_VERSIONING, commit, STATE)
        cli.main(["gold", "--root", root, "--database", "refreshed", "--incremental"], spark)
    cli.main(["gold", "--root", root, "--database", "refreshed", "--incremental"], spark)
    assert "up to date with commit 6" in capsys.readouterr().out
    whole = gold.status_funnel(changelog.current(spark, place, SILVER_VERSIONING))
    got = spark.table("refreshed.gold_status_funnel").drop(gold.UPDATED)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect()))


def test_distinct_keys_add_up(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 5), rng.choice([None, rng.randint(-70_000, 70_000)])) for _ in range(900)]
    rows = spark.createDataFrame(pairs, "day int, k long")
    stored = distinct.key_bitmaps(rows, "k", "day")
    per_day = {r.day: r.distinct_keys for r in distinct.distinct_keys(stored, "day").collect()}
    assert per_day == {d: len({k for e, k in pairs if e == d and k is not None}) for d in per_day}
    whole = distinct.distinct_keys(stored.drop("day")).first()[0]
    assert whole == len({k for _, k in pairs if k is not None})
    assert "bitmap_construct_agg" in stored._jdf.queryExecution().toString()


def test_numbers_are_the_order(spark):
    rng = random.Random(2)
    made = [(rng.randint(0, 50), i) for i in range(500)]
    rows = spark.createDataFrame(made, "a int, b int").repartition(7)
    got = numbering.numbered(rows, "a", "b", column="n").collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.n)] == sorted(made)
    assert sorted(r.n for r in got) == list(range(1, 501))
    assert numbering.numbered(rows.where("false"), "a").count() == 0


def test_last_row_is_the_last_in_file_order(spark, tmp_path):
    """The larger file is read first, but lies behind the small one."""
    (tmp_path / "a.csv").write_text("k,v\n" + "".join(f"{i},early\n" for i in range(3)))
    (tmp_path / "b.csv").write_text("k,v\n" + "".join(f"{i % 500},at{i}\n" for i in range(2000)))
    rows = spark.read.csv(str(tmp_path), header=True)
    got = {r.k: r.v for r in enrich.last_row(in_file_order(rows), "k", "_row").collect()}
    assert got == {str(i): f"at{i + 1500}" for i in range(500)}


def test_compaction_takes_partitions_of_small_files_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN CONCAT('p', id % 3) END AS p")
    rows.repartition(1).write.partitionBy("p").parquet(path)
    for _ in range(2):
        rows.where("p IS NULL OR p = 'p1'").repartition(1).write.mode("append").partitionBy("p").parquet(path)
    before = sorted(os.listdir(f"{path}/p=p2"))
    touched = layout.compact(spark, path, ["p"])
    assert sorted((r.p, r.small_files) for r in touched.where("p IS NOT NULL").collect()) == [("p1", 3)]
    assert touched.count() == 2 and before == sorted(os.listdir(f"{path}/p=p2"))
    assert {(r.p, r["count"]) for r in spark.read.parquet(path).groupBy("p").count().collect()} == {
        (None, 3000), ("p1", 3000), ("p2", 1000)}
    assert layout.compact(spark, path, ["p"]).count() == 0
    assert not exists(spark, str(tmp_path / "none")) and exists(spark, path)


def test_reports_with_named_parameters(spark):
    catalog.ensure_database(spark, "viewed")
    catalog.register(spark.createDataFrame(
        [("SP", 9.0, 3, 3.0, 1.0, 1, 3, 33.3), ("RJ", 8.0, 2, 4.0, None, 0, 2, 0.0)],
        "customer_state string, total_revenue double, order_count long, avg_order_value double,"
        "avg_delivery_delay_hrs double, late_deliveries long, total_records long,"
        "late_delivery_pct double"), "gold_state_metrics", "viewed")
    views.create_report(spark, "top_states_revenue", "viewed")
    assert [r.customer_state for r in views.read_report(
        spark, "top_states_revenue", "viewed", states=1).collect()] == ["SP"]
    assert views.read_report(spark, "top_states_revenue", "viewed").count() == 2


def test_a_late_split_that_runs_again_gives_no_row_twice(spark, tmp_path):
    path, root, hour = str(tmp_path / "wire"), str(tmp_path / "late"), 3600
    for rows in ([("a", 0)], [("a", 9 * hour), ("b", 9 * hour)], [("c", 0), ("d", 9 * hour)]):
        spark.createDataFrame([(k, 1_700_000_000 + t) for k, t in rows], "k string, s long").select(
            "k", F.timestamp_seconds("s").alias("t")).coalesce(1).write.mode("append").parquet(path)
    events = spark.readStream.schema("k string, t timestamp").option("maxFilesPerTrigger", 1).parquet(path)

    def split():
        late.split_late(events, root, "t").option("checkpointLocation", str(tmp_path / "cp1")).trigger(
            availableNow=True).start().awaitTermination()

    def unique():
        late.unique_on_time(spark, root, events.schema, ["k"]).writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "cp2")).option("path", str(tmp_path / "out")).trigger(
            availableNow=True).start().awaitTermination()
        return sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect())

    split()
    first = unique()
    assert first == ["a", "b", "d"]
    # The last batch had written its rows, but not that it was done.
    for name in ("2", ".2.crc"):
        place = tmp_path / "cp1" / "commits" / name
        if place.exists():
            place.unlink()
    split()
    assert unique() == first
    assert sorted(r.k for r in late.late_rows(spark, root, events.schema).collect()) == ["c"]
