"""Every operator as a query over the given tables.

A query ends in columns that any engine prints alike: times, dates and
booleans leave as text, counts as bigint, money as double.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.checks import inputs as given
from millrace.functions.columns import normalize_status as contract_status
from millrace.functions.measures import not_finite, total
from millrace.operators import distinct, enrich, evolution, late, layout, quality, versions
from millrace.operators.latest import latest_per_key, newest_first
from millrace.operators.numbering import numbered
from millrace.operators.parse import decode_envelope, parse_events, with_event_times
from millrace.operators.sizes import estimated_bytes
from millrace.plans import analytics, audit, dashboard, gold, refresh, views
from millrace.schema import QC_FLAGS, STATES
from millrace.session import prepare, scratch_dir
from millrace.sources import catalog, changelog
from millrace.sources.envelope import append_envelope_batch, file_stream, to_messages
from millrace.sources.tables import in_file_order, read_csv, read_layer, read_metrics
from millrace.streaming.console import console_views, progress_rows
from millrace.streaming.late import (
    dedup_within_watermark, late_rows, split_late, unique_on_time,
)
from millrace.streaming.medallion import (
    STREAM_VERSIONING, BatchWriter, Layers, start_ingest, stored_metrics, write_layer,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

EVENT_COLUMNS = ["order_id", "product_id", "seller_id", "quantity", "freight_value",
                 "total_price", "order_status", "customer_state", "event_ts"]
TIMES = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def portable(df: DataFrame) -> DataFrame:
    """Types that mean the same in every engine."""
    columns = []
    for field in df.schema:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DateType):
            column = F.date_format(column, TIMES["date"])
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, TIMES["timestamp"])
        elif isinstance(kind, T.BooleanType):
            column = column.cast("string")
        elif isinstance(kind, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(columns)


def register(build: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return portable(build(prepare(spark), sf))

    REGISTRY[build.__name__] = run
    return build


# --- silver views used by many queries ------------------------------------------------

def silver(spark: SparkSession, sf: str) -> DataFrame:
    """One valid row per order."""
    valid = quality.valid_rows(given.checked_events(spark, sf))
    return latest_per_key(valid, ["order_id"], newest_first("event_ts", ties=given.TIES))


def silver_per_batch(spark: SparkSession, sf: str) -> DataFrame:
    """One valid row per order and batch: what appending batches gives."""
    valid = quality.valid_rows(given.checked_events(spark, sf))
    return latest_per_key(
        valid, ["batch_id", "order_id"], newest_first("event_ts", ties=given.TIES)
    )


# --- quality --------------------------------------------------------------------------

@register
def qc_flags(spark, sf):
    return given.checked_events(spark, sf).select(
        "order_id", "product_id", "seller_id", "freight_value", *QC_FLAGS, "is_valid")


@register
def qc_three_valued_counts(spark, sf):
    return quality.three_valued_counts(given.order_events(spark, sf))


@register
def quarantine_reasons(spark, sf):
    return quality.rejection_reasons(
        quality.quarantined_rows(given.checked_events(spark, sf)))


@register
def batch_quality_metrics(spark, sf):
    return quality.batch_quality(given.checked_events(spark, sf), "batch_id")


@register
def cumulative_quality_metrics(spark, sf):
    per_batch = quality.batch_quality(given.checked_events(spark, sf), "batch_id")
    return quality.with_running_totals(per_batch).select(
        "batch_id", *quality.CUMULATIVE, "cumulative_batches")


def _written_metrics(spark, sf) -> str:
    """Metrics of seven batches as two generations of writers store them."""
    records = quality.batch_quality(given.checked_events(spark, sf), "batch_id").withColumn(
        "batch_duration_sec", F.col("total_records") / 1000.0)
    as_text = records.select([F.col(c).cast("string").alias(c) for c in records.columns])
    older = F.col("batch_id").cast("bigint") % 2 == 1
    path = scratch_dir(spark, "metrics")
    as_text.select(
        "*",
        F.when(~older, F.col("silver_records")).alias("silver_upserted"),
        F.when(older, F.col("silver_records")).alias("_older"),
    ).drop("silver_records").withColumnRenamed("_older", "silver_records").write.json(path)
    return path


@register
def metrics_json_scan(spark, sf):
    return read_metrics(spark, _written_metrics(spark, sf)).select(
        "batch_id", "total_records", "valid_records", "quarantine_records",
        "silver_records", "silver_upserted", "duplicates_removed")


@register
def metrics_typed(spark, sf):
    return dashboard.typed_metrics(read_metrics(spark, _written_metrics(spark, sf)))


@register
def quality_summary(spark, sf):
    return dashboard.quality_summary(
        dashboard.typed_metrics(read_metrics(spark, _written_metrics(spark, sf))))


# --- layers ---------------------------------------------------------------------------

def _layer(spark, rows, label, by="customer_state", rebalance=True):
    path = scratch_dir(spark, label)
    write_layer(rows, path, by, rebalance)
    return read_layer(spark, path)


@register
def bronze_layer(spark, sf):
    checked = given.checked_events(spark, sf)
    return _layer(spark, checked, "bronze").select(*EVENT_COLUMNS, "is_valid")


@register
def quarantine_layer(spark, sf):
    rejected = quality.quarantined_rows(given.checked_events(spark, sf))
    return _layer(spark, rejected, "quarantine", None).select(*EVENT_COLUMNS, *QC_FLAGS)


@register
def silver_layer_batch_dedup(spark, sf):
    return _layer(spark, silver_per_batch(spark, sf), "silver").select("batch_id", *EVENT_COLUMNS)


@register
def layer_scan_parquet(spark, sf):
    layer = _layer(spark, given.checked_events(spark, sf), "scan")
    return layer.groupBy("customer_state").agg(
        F.count("*").alias("records"), total("total_price").alias("amount"))


@register
def layer_counts(spark, sf):
    checked = given.checked_events(spark, sf)
    return audit.layer_counts({
        "bronze": checked,
        "silver_append": silver_per_batch(spark, sf),
        "silver_versions": silver(spark, sf),
        "quarantine": quality.quarantined_rows(checked),
    })


@register
def dedup_latest_per_key(spark, sf):
    timed = given.order_events(spark, sf).where("event_ts IS NOT NULL")
    newest = latest_per_key(timed, ["order_id"], newest_first("event_ts", ties=given.TIES))
    return newest.select(EVENT_COLUMNS)


@register
def latest_silver_sample(spark, sf):
    return audit.latest_rows(
        silver(spark, sf), [F.col("event_ts").desc_nulls_last(), "order_id"],
        ["order_id", "order_status", "customer_state", "total_price", "payment_type", "event_ts"])


# --- versioned table ------------------------------------------------------------------

ROW = ["order_id", "product_id", "total_price", "order_status", "event_ts", "_commit_time"]
USER_ROW = ["user_id", "event_id", "ts", "event_type", "value", "_commit_time"]


@register
def snapshot_latest(spark, sf):
    return versions.snapshot(given.users_log(spark, sf), given.USERS_LOG).select(USER_ROW)


@register
def time_travel_as_of(spark, sf):
    log = given.users_log(spark, sf)
    return versions.as_of(log, given.USERS_LOG, 20240115).select(USER_ROW)


@register
def incremental_since(spark, sf):
    log = given.users_log(spark, sf)
    return versions.changes(log, given.USERS_LOG, 20240128).select(USER_ROW)


@register
def incremental_between(spark, sf):
    log = given.orders_log(spark, sf)
    return versions.changes(log, given.ORDERS_LOG, 2, 5).select(ROW)


@register
def incremental_per_commit(spark, sf):
    return versions.changes_per_commit_pair(given.orders_log(spark, sf), given.ORDERS_LOG)


@register
def incremental_reduction(spark, sf):
    return audit.incremental_reduction(given.users_log(spark, sf), given.USERS_LOG)


def _upserted(spark, sf, commit) -> DataFrame:
    """The first four commits as a stored table, the others merged into it."""
    log = given.orders_log(spark, sf, commit)
    v = given.ORDERS_LOG
    root = scratch_dir(spark, "upsert")
    versions.snapshot(log.where(F.col(v.commit) <= 4), v).write.parquet(f"{root}/base")
    log.where(F.col(v.commit) > 4).write.parquet(f"{root}/delta")
    base, delta = spark.read.parquet(f"{root}/base"), spark.read.parquet(f"{root}/delta")
    return versions.merge_latest(base, delta, v).select(ROW)


@register
def upsert_latest_wins(spark, sf):
    return _upserted(spark, sf, "batch_id")


@register
def upsert_late_event_ignored(spark, sf):
    return _upserted(spark, sf, "shuffled_batch_id")


@register
def upsert_equal_time_and_commit(spark, sf):
    """Base and delta share key, time and commit; the tie-break decides."""
    v = given.ORDERS_LOG
    base = versions.as_of(given.orders_log(spark, sf), v, 4)
    delta = base.withColumn("seller_id", F.col("seller_id") + F.when(
        F.col("order_id") % 2 == 1, -1).otherwise(1))
    return versions.merge_latest(base, delta, v).select(*ROW, "seller_id")


@register
def upsert_bucketed_base(spark, sf):
    log, v = given.orders_log(spark, sf), given.ORDERS_LOG
    root, buckets = scratch_dir(spark, "buckets"), catalog.shuffle_width(spark)
    database = f"millrace_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, database, f"{root}/db")
    early = versions.snapshot(log.where(F.col(v.commit) <= 4), v)
    catalog.register_bucketed(early, "base", "order_id", buckets, database, f"{root}/base")
    delta = log.where(F.col(v.commit) > 4)
    return versions.merge_into_buckets(
        spark.table(f"{database}.base"), delta, v, buckets).select(ROW)


def _stored_log(spark, sf, commits=range(1, 8)) -> tuple[str, DataFrame]:
    root, log = scratch_dir(spark, "versions"), given.orders_log(spark, sf)
    for commit in commits:
        rows = log.where(F.col(given.ORDERS_LOG.commit) == commit)
        changelog.write_commit(rows, root, given.ORDERS_LOG, commit, "customer_state")
    return root, log


@register
def stored_table_with_base(spark, sf):
    """Five commits, shrunk to the state of the last, then two more."""
    root, log = _stored_log(spark, sf, range(1, 6))
    changelog.retain_last_commits(spark, root, given.ORDERS_LOG, 1, "customer_state")
    for commit in (6, 7):
        rows = log.where(F.col(given.ORDERS_LOG.commit) == commit)
        changelog.write_commit(rows, root, given.ORDERS_LOG, commit, "customer_state")
    return changelog.current(spark, root, given.ORDERS_LOG).select(ROW)


@register
def commit_timeline(spark, sf):
    return versions.surviving_commits(given.orders_log(spark, sf), given.ORDERS_LOG)


@register
def commit_timeline_log(spark, sf):
    return versions.commit_counts(given.orders_log(spark, sf), given.ORDERS_LOG)


@register
def time_travel_status_distribution(spark, sf):
    log = given.orders_log(spark, sf)
    return audit.status_distribution(log, given.ORDERS_LOG, 3, "order_status")


@register
def time_travel_growth(spark, sf):
    return audit.time_travel_growth(given.orders_log(spark, sf), given.ORDERS_LOG)


@register
def upsert_audit(spark, sf):
    return audit.duplicate_audit({
        "bronze": given.order_events(spark, sf), "silver": silver(spark, sf)})


@register
def multi_version_orders(spark, sf):
    return audit.multi_version_keys(given.order_events(spark, sf))


@register
def most_updated_order(spark, sf):
    return audit.most_updated_key(given.order_events(spark, sf))


@register
def order_version_history(spark, sf):
    log = given.orders_log(spark, sf)
    return audit.version_history(
        log, given.ORDERS_LOG, ["order_status", "event_ts", "product_id", "total_price"])


@register
def table_stats(spark, sf):
    log = given.orders_log(spark, sf)
    current = versions.snapshot(log, given.ORDERS_LOG)
    return audit.table_stats(current, given.ORDERS_LOG, "customer_state")


@register
def partition_row_counts(spark, sf):
    return audit.partition_row_counts(silver(spark, sf), "customer_state", top=15)


@register
def history_retention(spark, sf):
    log = given.orders_log(spark, sf)
    return versions.keep_last_commits(log, given.ORDERS_LOG, 3).select(ROW)


@register
def layout_rewrite_preserves_rows(spark, sf):
    # A large table's rows are put in place once, by the rewrite.
    layer = _layer(spark, given.checked_events(spark, sf), "unclustered",
                   rebalance=given.event_partitions(spark, sf) is None)
    path = scratch_dir(spark, "clustered")
    layout.rewrite(layer, path, "customer_state", ties=("order_id", *given.TIES))
    return read_layer(spark, path).select(EVENT_COLUMNS)


@register
def small_files_compacted(spark, sf):
    """States from M on lie in many small files, the others in one each: only the former are
    rewritten, and no row changes."""
    path, states = scratch_dir(spark, "files"), given.checked_events(spark, sf)
    many = F.col("customer_state") >= "M"
    layout.write_one_file_each(states.where(~many), path, "customer_state", STATES)
    for rest in range(3):
        layout.write_one_file_each(
            states.where(many & (F.pmod("product_id", F.lit(3)) == rest)), path, "customer_state",
            STATES, "append")
    before = read_layer(spark, path).select(F.col("_metadata.file_path").alias("file")).distinct()
    before = spark.createDataFrame(before.collect(), before.schema)
    layout.compact(spark, path, ["customer_state"])
    after = read_layer(spark, path).select("*", F.col("_metadata.file_path").alias("file"))
    kept = before.withColumn("kept", F.lit(True))
    return after.join(kept, "file", "left").groupBy("customer_state").agg(
        F.count("*").alias("records"), total("total_price").alias("amount"),
        F.countDistinct("file").alias("files"),
        F.bool_and(F.coalesce("kept", F.lit(False))).alias("untouched"))


@register
def table_files(spark, sf):
    """Files of each partition of a stored layer, by their metadata."""
    path = scratch_dir(spark, "files")
    layout.write_one_file_each(given.checked_events(spark, sf), path, "customer_state", STATES)
    layer = read_layer(spark, path)
    return layer.groupBy("customer_state").agg(
        F.countDistinct("_metadata.file_path").alias("files"), F.count("*").alias("records"))


@register
def distinct_orders_merged(spark, sf):
    """Orders per batch, and over all batches from the batches' bitmaps."""
    stored = distinct.key_bitmaps(given.order_events(spark, sf), "order_id", "batch_id")
    whole = distinct.distinct_keys(stored.drop("batch_id")).withColumn(
        "batch_id", F.lit(None).cast("bigint"))
    return distinct.distinct_keys(stored, "batch_id").unionByName(whole)


@register
def distinct_customers_rolling(spark, sf):
    """Customers of the seven days up to each day with orders."""
    dated = given.order_events(spark, sf).where("event_ts IS NOT NULL").withColumn(
        "day", F.to_date("event_ts"))
    daily = distinct.key_bitmaps(dated, "customer_id", "day")
    return distinct.distinct_keys(distinct.rolling_bitmaps(daily, "day", 7), "day")


# --- schema evolution -----------------------------------------------------------------

def _evolution(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The table before and after rows with two more columns were upserted."""
    log = given.orders_log(spark, sf)
    before = versions.snapshot(log, given.ORDERS_LOG)
    delivered = before.where("order_status = 'delivered'")
    added = evolution.with_added_columns(delivered, portable=True).withColumn(
        given.ORDERS_LOG.commit, F.lit(8).cast("bigint"))
    return before, versions.merge_latest(before, added, given.ORDERS_LOG)


@register
def evolve_schema(spark, sf):
    _, after = _evolution(spark, sf)
    return after.select(*ROW, *evolution.ADDED_COLUMNS)


@register
def evolution_null_audit(spark, sf):
    _, after = _evolution(spark, sf)
    return evolution.null_audit(after)


@register
def evolution_sample(spark, sf):
    before = versions.snapshot(given.orders_log(spark, sf), given.ORDERS_LOG)
    sample = evolution.sample_to_evolve(before)
    return evolution.with_added_columns(sample, portable=True).select(
        "order_id", "order_status", *evolution.ADDED_COLUMNS)


@register
def schema_diff(spark, sf):
    before, after = _evolution(spark, sf)
    columns = ["order_id", "quantity", "total_price", "order_status", "event_ts"]
    return evolution.schema_report(
        before.select(columns), after.select(*columns, *evolution.ADDED_COLUMNS)
    ).drop("nullable")


# --- gold and analytics ---------------------------------------------------------------

@register
def gold_daily_revenue(spark, sf):
    return gold.daily_revenue(silver(spark, sf))


@register
def gold_state_metrics(spark, sf):
    return gold.state_metrics(silver(spark, sf))


@register
def gold_status_funnel(spark, sf):
    return gold.status_funnel(silver(spark, sf))


@register
def gold_category_performance(spark, sf):
    return gold.category_performance(silver(spark, sf))


@register
def gold_full_refresh(spark, sf):
    path = scratch_dir(spark, "gold")
    gold.write_gold(gold.state_metrics(silver(spark, sf)), path)
    return read_layer(spark, path).drop(gold.UPDATED)


@register
def gold_upsert(spark, sf):
    """States of the first four batches, then refreshed with those of all batches."""
    path, v = scratch_dir(spark, "gold"), given.ORDERS_LOG
    log = given.orders_log(spark, sf)
    early = gold.status_funnel(versions.as_of(log, v, 4))
    gold.write_gold(early, path)
    now = gold.status_funnel(versions.snapshot(log, v)).where("order_status <> 'created'")
    merged = gold.refreshed(read_layer(spark, path), gold.with_update_time(now), "order_status")
    return merged.drop(gold.UPDATED)


def _from_changes(spark, sf, mode) -> DataFrame:
    """Gold of the first three commits, then brought up to date twice. Late and repeated orders move
    between groups; silver is not read again."""
    log, v, table = given.orders_log(spark, sf), given.ORDERS_LOG, refresh.tables()[mode]
    path = scratch_dir(spark, "parts")
    early = refresh.first_rows(versions.as_of(log, v, 3))
    refresh.parts_of(early, table).write.parquet(path)
    now = refresh.refreshed(spark.read.parquet(path), log, v, [(3, 5), (5, 7)], table)
    return table.finish(now)


@register
def gold_daily_from_changes(spark, sf):
    return _from_changes(spark, sf, "daily")


@register
def gold_state_from_changes(spark, sf):
    return _from_changes(spark, sf, "state")


@register
def gold_status_from_changes(spark, sf):
    return _from_changes(spark, sf, "status")


@register
def gold_category_from_changes(spark, sf):
    return _from_changes(spark, sf, "category")


@register
def daily_revenue_trend(spark, sf):
    return analytics.daily_revenue_trend(gold.daily_revenue(silver(spark, sf)))


@register
def top_states_revenue(spark, sf):
    return analytics.top_states_revenue(gold.state_metrics(silver(spark, sf)))


@register
def status_funnel_pct(spark, sf):
    return analytics.status_funnel_pct(gold.status_funnel(silver(spark, sf)))


@register
def top_categories(spark, sf):
    return analytics.top_categories(gold.category_performance(silver(spark, sf)))


@register
def payment_method_breakdown(spark, sf):
    return analytics.payment_method_breakdown(silver(spark, sf))


@register
def hourly_distribution(spark, sf):
    return analytics.hourly_distribution(silver(spark, sf))


@register
def customer_concentration(spark, sf):
    return analytics.customer_concentration(gold.state_metrics(silver(spark, sf)))


@register
def delivery_sla(spark, sf):
    return analytics.delivery_sla(gold.state_metrics(silver(spark, sf)))


def _catalog(spark, sf) -> str:
    database = f"millrace_{uuid.uuid4().hex[:8]}"
    root = scratch_dir(spark, "catalog")
    catalog.ensure_database(spark, database, root)
    catalog.register_bucketed(
        silver(spark, sf), "orders_silver", "order_id", catalog.shuffle_width(spark),
        database, f"{root}/orders_silver")
    stored = spark.table(f"{database}.orders_silver")
    for name, table in gold.build_all(stored).items():
        catalog.register(table, name, database, f"{root}/{name}")
    return database


@register
def catalog_tables(spark, sf):
    database = _catalog(spark, sf)
    names = sorted(row.tableName for row in catalog.tables(spark, database).collect())
    return audit.layer_counts(
        {name: spark.table(f"{database}.{name}") for name in names}
    ).withColumnRenamed("layer", "table_name")


@register
def catalog_report(spark, sf):
    return analytics.run_report(spark, "payment_method_breakdown", _catalog(spark, sf))


def _viewed(spark, sf, name, **parameters) -> DataFrame:
    """A report read through the catalog, over the one table that it needs."""
    database, root = f"millrace_{uuid.uuid4().hex[:8]}", scratch_dir(spark, "catalog")
    catalog.ensure_database(spark, database, root)
    table = analytics.SUITE[name].table
    rows = silver(spark, sf)
    catalog.register(
        rows if table == "orders_silver" else gold.build_all(rows)[table], table, database,
        f"{root}/{table}")
    views.create_report(spark, name, database)
    return views.read_report(spark, name, database, **parameters)


@register
def view_daily_revenue_trend(spark, sf):
    return _viewed(spark, sf, "daily_revenue_trend")


@register
def view_top_states_revenue(spark, sf):
    return _viewed(spark, sf, "top_states_revenue", states=10)


@register
def view_status_funnel(spark, sf):
    return _viewed(spark, sf, "status_funnel")


@register
def view_top_categories(spark, sf):
    return _viewed(spark, sf, "top_categories", up_to=20)


@register
def view_payment_method_breakdown(spark, sf):
    return _viewed(spark, sf, "payment_method_breakdown")


@register
def view_hourly_distribution(spark, sf):
    return _viewed(spark, sf, "hourly_distribution")


@register
def view_customer_concentration(spark, sf):
    return _viewed(spark, sf, "customer_concentration")


@register
def view_delivery_sla(spark, sf):
    return _viewed(spark, sf, "delivery_sla")


# --- shop tables to events ------------------------------------------------------------

@register
def payments_per_order(spark, sf):
    return enrich.payments_per_order(given.shop_tables(spark, sf, unpaid=None)["payments"])


@register
def enriched_order_events(spark, sf):
    return enrich.chronological(enrich.order_item_events(**given.shop_tables(spark, sf)))


@register
def enriched_order_events_repeats(spark, sf):
    """Every third customer and product comes twice; the later row counts."""
    shop = given.shop_tables(spark, sf)
    customers = shop["customers"].withColumn("seq", F.lit(1))
    products = shop["products"].withColumn("seq", F.lit(1))
    moved = customers.where("customer_id % 3 = 0").withColumns(
        {"customer_city": F.lit("moved"), "seq": F.lit(2)})
    renamed = products.where("CAST(product_id AS BIGINT) % 3 = 0").withColumns(
        {"product_category_name": F.lit("renamed"), "seq": F.lit(2)})
    shop |= {"customers": customers.union(moved), "products": products.union(renamed)}
    return enrich.order_item_events(**shop, customer_sequence="seq", product_sequence="seq")


@register
def replay_order(spark, sf):
    """The number of each event in the replay."""
    order = ["event_time", "order_id", "product_id", "seller_id", "total_price"]
    events = enrich.order_item_events(**given.shop_tables(spark, sf))
    return numbered(events.select(order), *order, column="replay_number")


@register
def last_customer_in_file_order(spark, sf):
    """A small file, then a large one with other rows for the same customers: the later file's count."""
    customers, path = given.shop_tables(spark, sf)["customers"], scratch_dir(spark, "shop")
    again = customers.where("customer_id % 3 = 0")
    again.coalesce(1).write.csv(f"{path}/a", header=True)
    customers.withColumn("customer_city", F.when(
        F.col("customer_id") % 3 == 0, "moved").otherwise(F.col("customer_city"))).coalesce(
        1).write.csv(f"{path}/b", header=True)
    stored = spark.read.schema("customer_id bigint, customer_state string, customer_city string").csv(
        [f"{path}/a", f"{path}/b"], header=True)
    return enrich.last_row(in_file_order(stored), "customer_id", "_row")


@register
def money_sums_wide(spark, sf):
    """Amounts beyond 64 bits, and amounts that are no numbers."""
    spoilt = F.when(F.col("l_partkey") % 50 == 0, F.lit(float("nan")))
    amounts = given.table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("line"),
        (F.col("l_extendedprice") * F.lit(1e15)).alias("wide"), spoilt.isNull().alias("whole"),
        F.coalesce(spoilt, "l_quantity").alias("spoilt"))
    return amounts.groupBy("line").agg(
        total("wide").alias("wide_total"),
        total(F.when(F.col("whole"), F.col("spoilt"))).alias("finite_total"),
        not_finite("spoilt").alias("not_finite"),
        F.isnan(total("spoilt")).alias("spoilt_total_is_nan"))


@register
def normalize_status(spark, sf):
    raw = F.element_at(F.array(*map(F.lit, [
        "created", "approved", "invoiced", "processing", "shipped", "delivered",
        "unavailable", "canceled", "lost"])), (F.col("o_orderkey") % 9 + 1).cast("int"))
    orders = given.table(spark, sf, "orders").select(raw.alias("raw_status"))
    return orders.groupBy("raw_status", contract_status("raw_status").alias("order_status")).agg(
        F.count("*").alias("records"))


@register
def csv_roundtrip_scan(spark, sf):
    path = scratch_dir(spark, "csv")
    orders = given.shop_tables(spark, sf)["orders"]
    orders.write.options(header=True, emptyValue="").csv(path)
    ddl = """order_id BIGINT, customer_id BIGINT, order_status STRING,
        order_purchase_timestamp STRING, order_delivered_customer_date STRING,
        order_estimated_delivery_date STRING"""
    return read_csv(spark, path, ddl)


PAYLOAD = ["order_id", "customer_id", "product_id", "product_category", "seller_id", "quantity",
           "unit_price", "freight_value", "total_price", "order_status", "customer_state",
           "payment_type", "payment_value", "event_time", "order_delivered_ts",
           "order_estimated_ts"]


def _messages(spark, sf, parts=None) -> DataFrame:
    """One message per event; the line is the partition, the part the offset."""
    events = given.event_payloads(spark, sf, parts)
    sent = F.coalesce(F.try_to_timestamp("order_estimated_ts"), F.timestamp_seconds(F.lit(0)))
    return to_messages(
        events.withColumns({
            "partition": F.col("batch_id").cast("int"),
            "offset": F.col("product_id").cast("bigint"),
            "timestamp": sent,
        }),
        rest=["batch_id", "shuffled_batch_id", "partition", "offset", "timestamp"])


@register
def event_json_publish(spark, sf):
    messages = _messages(spark, sf).select(
        F.col("key"), F.col("value"), F.lit("orders").alias("topic"),
        "partition", "offset", "timestamp")
    return parse_events(messages).select("msg_key", "kafka_partition", *PAYLOAD)


@register
def parse_json_events(spark, sf):
    """Every 67th part's text is cut short, every 61st part's quantity is no number."""
    part = F.col("offset")
    spoilt = (
        F.when(part % 67 == 0, F.substring("value", 1, 40))
        .when(part % 61 == 0, F.regexp_replace("value", '"quantity":[0-9]+', '"quantity":"many"'))
        .otherwise(F.col("value"))
    )
    messages = _messages(spark, sf).select(
        "key", spoilt.alias("value"), F.lit("orders").alias("topic"),
        "partition", "offset", "timestamp")
    parsed = parse_events(messages).withColumn("has_text", F.col("json_str").isNotNull())
    return parsed.select(
        "msg_key", "kafka_partition", "kafka_offset", "has_text",
        "product_id", "quantity", "freight_value", "order_status", "event_ts")


@register
def parse_event_timestamps(spark, sf):
    """Every 59th part has a blank time, every 53rd one in another format."""
    part = F.col("product_id").cast("bigint")
    spoilt = (
        F.when(part % 59 == 0, "")
        .when(part % 53 == 0, F.replace("event_time", F.lit("-"), F.lit("/")))
        .otherwise(F.col("event_time"))
    )
    events = given.event_payloads(spark, sf).withColumn("event_time", spoilt)
    return with_event_times(events).select(
        "order_id", "product_id", "seller_id", "freight_value", "total_price",
        "event_ts", "processing_ts")


# --- streams --------------------------------------------------------------------------

# Line items behind one file of an arrival batch, as the table stores them.
BATCH_FILE_BYTES = 8 * 1024 * 1024
# Staged messages that one task of a bulk load reads: about half a million.
BULK_SPLIT = "24m"


def _files(spark: SparkSession) -> int:
    """Files per arrival batch: one for every slot."""
    return spark.sparkContext.defaultParallelism


def _batch_files(spark, sf) -> int:
    """Files per arrival batch of order events: one for every slot, and more for large tables,
    whose joins deal them out."""
    if given.event_partitions(spark, sf) is None:
        return _files(spark)
    items = estimated_bytes(given.table(spark, sf, "lineitem"))
    return max(_files(spark), catalog.shuffle_width(spark), items // (3 * BATCH_FILE_BYTES))


def _stage(spark, sf, path, arrivals=(0, 1, 2), stamp=None) -> None:
    """Messages in arrival batches; shuffled, so older events come late. ``stamp`` gives the
    messages of an arrival another timestamp."""
    files = _batch_files(spark, sf)
    messages = _messages(spark, sf, files)
    arrival = F.expr("(shuffled_batch_id - 1) div 3")
    for number in arrivals:
        batch = messages.where(arrival == number)
        if stamp:
            batch = batch.withColumn("timestamp", stamp(number))
        append_envelope_batch(batch, path, None)


def _wire(spark, sf, path) -> DataFrame:
    """The staged messages as a stream, a batch per arrival."""
    return file_stream(spark, path, _batch_files(spark, sf))


def _ingest(spark, path, layers, checkpoint, versioned=False, query="replay", sf=None):
    """Ingest what is staged; with ``sf`` in the batches that :func:`_stage` made of its tables.
    Those of a large table are a bulk load, whose tasks sort what they read by state in memory."""
    wire = file_stream(spark, path, _files(spark)) if sf is None else _wire(spark, sf, path)
    with _load(spark, sf) as rebalance:
        start_ingest(wire, layers, checkpoint, query, versioned, every=None,
                     rebalance=rebalance).awaitTermination()


@contextmanager
def _load(spark, sf):
    """The splits of a bulk load while it runs, and whether its layers are rebalanced."""
    small = sf is None or given.event_partitions(spark, sf) is None
    splits = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(splits)
    spark.conf.set(splits, before if small else BULK_SPLIT)
    try:
        yield small
    finally:
        spark.conf.set(splits, before)


@register
def stream_medallion_pipeline(spark, sf):
    path, root = scratch_dir(spark, "wire"), scratch_dir(spark, "lake")
    layers = Layers(root)
    _stage(spark, sf, path)
    _ingest(spark, path, layers, f"{root}/checkpoint", sf=sf)
    parts = [
        read_layer(spark, place).groupBy("batch_id").agg(
            F.lit(name).alias("layer"), F.count("*").alias("records"),
            total("payment_value").alias("amount"))
        for name, place in (
            ("bronze", layers.bronze), ("quarantine", layers.quarantine),
            ("silver", layers.silver))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register
def stream_metrics(spark, sf):
    path, root = scratch_dir(spark, "wire"), scratch_dir(spark, "lake")
    layers = Layers(root)
    _stage(spark, sf, path)
    _ingest(spark, path, layers, f"{root}/checkpoint", sf=sf)
    return stored_metrics(spark, layers).drop("batch_duration_sec")


@register
def stream_upsert(spark, sf):
    path, root = scratch_dir(spark, "wire"), scratch_dir(spark, "lake")
    layers = Layers(root)
    _stage(spark, sf, path)
    _ingest(spark, path, layers, f"{root}/checkpoint", versioned=True, sf=sf)
    return changelog.current(spark, layers.silver_versions, STREAM_VERSIONING).select(
        "order_id", "product_id", "seller_id", "total_price", "order_status", "event_ts",
        "_commit_time")


@register
def stream_restart_no_duplicates(spark, sf):
    """Two batches, a stop, the third batch, and the second one once more as
    after a failure. No row may be there twice."""
    path, root = scratch_dir(spark, "wire"), scratch_dir(spark, "lake")
    layers = Layers(root)
    _stage(spark, sf, path, (0, 1))
    _ingest(spark, path, layers, f"{root}/checkpoint", sf=sf)
    _stage(spark, sf, path, (2,))
    _ingest(spark, path, layers, f"{root}/checkpoint", sf=sf)
    again = spark.read.parquet(path).where("((1 + (partition * 3) % 7) - 1) div 3 = 1")
    with _load(spark, sf) as rebalance:
        BatchWriter(layers, "replay", rebalance=rebalance)(parse_events(again), 1)
    return read_layer(spark, layers.bronze).groupBy("batch_id").agg(
        F.count("*").alias("records"),
        F.countDistinct("order_id").alias("orders"),
        total("freight_value").alias("freight"))


def _to_files(rows: DataFrame, spark, label) -> DataFrame:
    """Run a stateless stream to its end into a folder and read that."""
    out = scratch_dir(spark, label)
    query = rows.writeStream.format("parquet").outputMode("append").options(
        path=f"{out}/rows", checkpointLocation=f"{out}/checkpoint",
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{out}/rows")


@register
def stream_envelope_replay(spark, sf):
    events = given.table(spark, sf, "events")
    messages = to_messages(
        events.withColumns({
            "partition": (F.col("user_id") % 3).cast("int"),
            "offset": F.col("event_id"),
            "timestamp": F.col("ts").cast("timestamp"),
        }),
        key="user_id", rest=["partition", "offset", "timestamp"])
    path = scratch_dir(spark, "wire")
    append_envelope_batch(messages, path, _files(spark))
    decoded = _to_files(decode_envelope(file_stream(spark, path)), spark, "decoded")
    payload = F.from_json("json_str", "event_id BIGINT, event_type STRING, value DOUBLE")
    return decoded.select(
        "msg_key", "topic", "kafka_partition", "kafka_offset", "kafka_ts",
        payload.alias("payload")
    ).select("*", "payload.*").drop("payload")


@register
def console_valid_view(spark, sf):
    path = scratch_dir(spark, "wire")
    _stage(spark, sf, path)
    valid, _ = console_views(_wire(spark, sf, path))
    return _to_files(valid, spark, "valid")


@register
def console_quarantine_view(spark, sf):
    path = scratch_dir(spark, "wire")
    _stage(spark, sf, path)
    _, rejected = console_views(_wire(spark, sf, path))
    shown = _to_files(rejected, spark, "rejected")
    return shown.select(
        "order_id", F.get_json_object("json_str", "$.product_id").alias("json_product_id"),
        *QC_FLAGS)


@register
def stream_progress(spark, sf):
    """Rows per batch of two named queries that run at once."""
    path, root = scratch_dir(spark, "wire"), scratch_dir(spark, "views")
    _stage(spark, sf, path)
    views = console_views(_wire(spark, sf, path))
    tag = uuid.uuid4().hex[:8]
    running = [
        view.writeStream.format("noop").queryName(f"{name} {tag}").option(
            "checkpointLocation", f"{root}/{name}").trigger(availableNow=True).start()
        for name, view in zip(("valid-view", "quarantine-view"), views)]
    for query in running:
        query.awaitTermination()
    return progress_rows(spark, running).withColumn(
        "query", F.split_part("query", F.lit(" "), F.lit(1)))


@register
def stream_watermark_dedup(spark, sf):
    """Messages carry their arrival, a minute per batch, so that none is behind the
    watermark: every order is there, once."""
    path = scratch_dir(spark, "wire")
    _stage(spark, sf, path, stamp=lambda number: F.timestamp_seconds(
        F.lit(1_700_000_000 + 60 * number)))
    parsed = parse_events(_wire(spark, sf, path)).where("order_id IS NOT NULL")
    unique = dedup_within_watermark(parsed, ["order_id"])
    return _to_files(unique.select("order_id"), spark, "unique")


@register
def stream_late_side_output(spark, sf):
    """Every fifth order's messages after the first arrival are three hours old: they are all in
    the side output, first sightings or not; the others are there once per order."""
    path, root = scratch_dir(spark, "wire"), scratch_dir(spark, "late")

    def stamp(number):
        old = (F.lit(number) > 0) & (F.col("key").cast("bigint") % 5 == 0)
        return F.timestamp_seconds(
            F.lit(1_700_000_000 + 60 * number) - F.when(old, 10_800).otherwise(0))

    _stage(spark, sf, path, stamp=stamp)
    parsed = parse_events(_wire(spark, sf, path)).where("order_id IS NOT NULL")
    sent = parsed.select("order_id", "kafka_ts")
    split_late(sent, root).option("checkpointLocation", f"{root}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    unique = _to_files(unique_on_time(spark, root, sent.schema, ["order_id"]), spark, "unique")
    return unique.unionByName(late_rows(spark, root, sent.schema)).groupBy("order_id", "is_late").agg(
        F.count(F.lit(1)).alias("messages"))


@register
def late_event_split(spark, sf):
    """Every 50th user event arrives 36 hours after it happened."""
    arrived = F.expr("ts + CASE WHEN event_id % 50 = 0 THEN INTERVAL 36 HOURS"
                     " ELSE INTERVAL 0 HOURS END")
    events = given.table(spark, sf, "events").withColumn(
        "arrival_day", F.date_format(arrived, "yyyyMMdd").cast("bigint"))
    marked = late.with_lateness(events, "arrival_day", "ts", "1 HOUR")
    return marked.select("event_id", "arrival_day", "ts", "watermark", "is_late")
