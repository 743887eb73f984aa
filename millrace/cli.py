"""Command line: one sub-command per job.

    spark-submit --py-files millrace.zip millrace_job.py <job> [options]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import enrich, evolution, layout, quality, versions
from millrace.plans import analytics, audit, dashboard, gold, refresh, views
from millrace.schema import DEFAULT_DATABASE, DEFAULT_TOPIC
from millrace.session import build_session
from millrace.sources import catalog, changelog
from millrace.sources.envelope import kafka_stream, publish, to_messages
from millrace.sources.tables import exists, in_file_order, read_layer, read_shop
from millrace.streaming.console import start_console
from millrace.streaming.medallion import (
    SILVER_VERSIONING, STATE, Layers, start_ingest, stored_metrics,
)

SILVER_TABLE = "orders_silver"
MAINTAINED = [SILVER_TABLE, *(table for table, _, _ in gold.GOLD_TABLES.values())]


def ingest(spark: SparkSession, args) -> None:
    raw = kafka_stream(spark, args.servers, args.topic, max_offsets=args.max_offsets)
    name = "versioned-pipeline" if args.versioned else "streaming-pipeline"
    start_ingest(
        raw, Layers(args.root), args.checkpoint, args.query or name, args.versioned,
        every=args.every, first_commit=args.first_commit)
    spark.streams.awaitAnyTermination()


def console(spark: SparkSession, args) -> None:
    start_console(kafka_stream(spark, args.servers, args.topic, "latest", max_offsets=None))
    spark.streams.awaitAnyTermination()


def replay(spark: SparkSession, args) -> None:
    events = enrich.chronological(enrich.order_item_events(
        **_in_file_order(read_shop(spark, args.data)),
        customer_sequence="_row", product_sequence="_row"))
    stamped = events.withColumn("processing_time", F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    publish(to_messages(stamped), args.servers, args.topic)


def _in_file_order(shop: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Customers and products with their place in the files: of repeats the last row counts."""
    return {name: in_file_order(rows) if name in ("customers", "products") else rows
            for name, rows in shop.items()}


def _silver(spark: SparkSession, root: str) -> DataFrame:
    """The versioned table where there is one, else the appended layer; says which."""
    layers = Layers(root)
    if exists(spark, layers.silver_versions):
        print("silver: the versioned table, one row per order")
        return changelog.current(spark, layers.silver_versions, SILVER_VERSIONING)
    print("silver: the appended layer, one row per order and batch")
    return read_layer(spark, layers.silver)


def build_gold(spark: SparkSession, args) -> None:
    if args.incremental:
        refresh_gold(spark, args)
        return
    modes = tuple(gold.GOLD_TABLES) if args.mode == "all" else (args.mode,)
    catalog.ensure_database(spark, args.database)
    # Silver is written once under its catalog name; every gold table reads that,
    # and counts distinct orders inside the buckets.
    places = Layers(args.root)
    catalog.register_bucketed(
        _silver(spark, args.root), SILVER_TABLE, "order_id",
        args.buckets or catalog.shuffle_width(spark),
        args.database, f"{places.gold}/{SILVER_TABLE}")
    silver = spark.table(f"{args.database}.{SILVER_TABLE}")
    for name, table in gold.build_all(silver, modes).items():
        catalog.register(
            gold.with_update_time(table), name, args.database, f"{places.gold}/{name}")
    if set(modes) == set(gold.GOLD_TABLES):
        for name in analytics.SUITE:
            views.create_report(spark, name, args.database)
    catalog.tables(spark, args.database).show(truncate=False)


def refresh_gold(spark: SparkSession, args) -> None:
    """All gold tables from what changed since the last refresh; the first one reads all."""
    places, v = Layers(args.root), SILVER_VERSIONING
    log = changelog.read_log(spark, places.silver_versions, v)
    newest = changelog.commits(spark, places.silver_versions, v)[-1]
    parts = f"{places.gold}/parts"
    last = None
    if exists(spark, parts):
        last = spark.read.parquet(f"{parts}/*/daily").select(
            F.max(F.regexp_extract("_metadata.file_path", "/upto=([0-9]+)/", 1).cast("bigint"))
        ).first()[0]
    if last == newest:
        print("gold is up to date with commit", newest)
        return
    changes = (refresh.first_rows(versions.snapshot(log, v)) if last is None
               else refresh.row_changes(log, v, last))
    catalog.ensure_database(spark, args.database)
    for mode, table in refresh.tables().items():
        sums = refresh.parts_of(changes, table)
        if last is not None:
            sums = refresh.merged(spark.read.parquet(f"{parts}/upto={last}/{mode}"), sums, table)
        sums.write.mode("overwrite").parquet(f"{parts}/upto={newest}/{mode}")
        name = gold.GOLD_TABLES[mode][0]
        catalog.register(
            gold.with_update_time(table.finish(
                spark.read.parquet(f"{parts}/upto={newest}/{mode}"))),
            name, args.database, f"{places.gold}/{name}")
    print("gold refreshed from commit", last, "to", newest)


def run_analytics(spark: SparkSession, args) -> None:
    for name in [args.report] if args.report else analytics.SUITE:
        report = analytics.SUITE[name]
        print(f"\n{report.title}")
        if args.root:
            table = read_layer(spark, f"{Layers(args.root).gold}/{report.table}")
        else:
            table = spark.table(f"{args.database}.{report.table}")
        report.build(table).show(50, truncate=False)


def show_dashboard(spark: SparkSession, args) -> None:
    layers, v = Layers(args.root), SILVER_VERSIONING
    if exists(spark, layers.metrics):
        metrics = stored_metrics(spark, layers)
        dashboard.quality_summary(metrics).show(truncate=False, vertical=True)
        dashboard.batch_breakdown(metrics).show(100, truncate=False)
    else:
        print("metrics: no data yet")
    versioned = exists(spark, layers.silver_versions)
    there = {
        name: read_layer(spark, path) for name, path in (
            ("bronze", layers.bronze), ("quarantine", layers.quarantine))
        if exists(spark, path)}
    if versioned or exists(spark, layers.silver):
        there["silver"] = _silver(spark, args.root)
    for name in ("bronze", "quarantine", "silver"):
        if name not in there:
            print(f"{name}: no data yet")
    if there:
        audit.layer_counts(there).show(truncate=False)
    if "silver" in there:
        audit.latest_rows(
            there["silver"], [F.col("event_ts").desc_nulls_last(), "order_id"],
            ["order_id", "order_status", "customer_state", "total_price", "payment_type",
             "event_ts"]).show(truncate=False)
    if versioned:
        log = changelog.read_log(spark, layers.silver_versions, v)
        versions.surviving_commits(log, v).orderBy(v.commit).show(100, truncate=False)
        audit.duplicate_audit({"silver": there["silver"]}).show(truncate=False)
    if "quarantine" in there:
        quality.rejection_reasons(there["quarantine"]).orderBy(
            F.col("records").desc()).show(20, truncate=False)


def inspect_versions(spark: SparkSession, args) -> None:
    layers, v = Layers(args.root), SILVER_VERSIONING
    log = changelog.read_log(spark, layers.silver_versions, v)
    if args.mode in ("all", "upsert"):
        bronze = read_layer(spark, layers.bronze)
        audit.duplicate_audit({
            "bronze": bronze, "silver": changelog.current(spark, layers.silver_versions, v),
        }).show(truncate=False)
        for row in audit.most_updated_key(bronze).collect():
            audit.versions_of(bronze, "order_id", row.order_id, ["event_time"]).select(
                "order_id", "order_status", "event_time", "ingestion_ts").show(truncate=False)
    if args.mode in ("all", "timetravel"):
        versions.surviving_commits(log, v).orderBy(v.commit).show(100, truncate=False)
        growth = audit.time_travel_growth(log, v)
        growth.show(truncate=False)
        for row in growth.collect():
            for commit in (row.early_commit, row.late_commit):
                state = changelog.current(spark, layers.silver_versions, v, commit)
                state.groupBy("order_status").count().show(truncate=False)
    if args.mode in ("all", "incremental"):
        audit.incremental_reduction(log, v).show(truncate=False)
        versions.changes_per_commit_pair(log, v).orderBy("end_commit").show(100, truncate=False)


def evolve(spark: SparkSession, args) -> None:
    root, v = Layers(args.root).silver_versions, SILVER_VERSIONING
    before = changelog.current(spark, root, v)
    if evolution.already_evolved(before):
        print("the added columns are there already")
        return
    added = evolution.with_added_columns(evolution.sample_to_evolve(before, args.rows))
    if added.isEmpty():
        print("no delivered order to evolve")
        return
    commit = changelog.commits(spark, root, v)[-1] + 1
    changelog.write_commit(added, root, v, commit, STATE)
    after = changelog.current(spark, root, v)
    evolution.schema_report(before, after).show(100, truncate=False)
    evolution.null_audit(after).show(truncate=False)


def maintain(spark: SparkSession, args) -> None:
    wanted = MAINTAINED if args.table == "all" else [args.table]
    for name in wanted:
        print(f"\n{name}")
        if name == SILVER_TABLE:
            _maintain_silver(spark, args)
        elif args.operation in ("all", "stats"):
            _gold_stats(spark, f"{Layers(args.root).gold}/{name}")


def _maintain_silver(spark: SparkSession, args) -> None:
    root, v = Layers(args.root).silver_versions, SILVER_VERSIONING
    if args.operation in ("all", "stats"):
        table = changelog.current(spark, root, v)
        audit.table_stats(table, v, STATE).show(truncate=False)
        audit.partition_row_counts(table, STATE, top=15).show(truncate=False)
    if args.operation in ("all", "clean"):
        print("dropped commits:", changelog.retain_last_commits(spark, root, v, args.keep, STATE))
    if args.operation in ("all", "cluster", "compact"):
        sort_by = () if args.operation == "compact" else ("event_ts",)
        layout.compact(spark, root, (v.commit, STATE), sort_by=sort_by).show(truncate=False)


def _gold_stats(spark: SparkSession, path: str) -> None:
    """A refresh replaces a gold table as a whole: it has no history to clean
    and no tail to compact."""
    if not exists(spark, path):
        print("not built yet")
        return
    table = read_layer(spark, path)
    audit.file_counts(table).show(truncate=False)
    print("rows:", table.count())


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, **options):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for option, settings in options.items():
            sub.add_argument(f"--{option.replace('_', '-')}", **settings)

    servers, topic = {"required": True}, {"default": DEFAULT_TOPIC}
    root, database = {"required": True}, {"default": DEFAULT_DATABASE}
    job("ingest", ingest, servers=servers, topic=topic, root=root,
        checkpoint={"required": True}, versioned={"action": "store_true"}, query={},
        every={"default": "30 seconds"}, first_commit={"type": int, "default": 0},
        max_offsets={"type": int, "default": 10_000})
    job("console", console, servers=servers, topic=topic)
    job("replay", replay, data={"required": True}, servers=servers, topic=topic)
    job("gold", build_gold, root=root, database=database, buckets={"type": int},
        incremental={"action": "store_true"},
        mode={"default": "all", "choices": ["all", *gold.GOLD_TABLES]})
    job("analytics", run_analytics, database=database, root={},
        report={"choices": list(analytics.SUITE)})
    job("dashboard", show_dashboard, root=root)
    job("versions", inspect_versions, root=root,
        mode={"default": "all", "choices": ["all", "upsert", "timetravel", "incremental"]})
    job("evolve", evolve, root=root, rows={"type": int, "default": 100})
    job("maintain", maintain, root=root, keep={"type": int, "default": 5},
        operation={"default": "all", "choices": ["all", "stats", "clean", "cluster", "compact"]},
        table={"default": "all", "choices": ["all", *MAINTAINED]})
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(f"millrace-{args.job}"), args)


if __name__ == "__main__":
    main()
