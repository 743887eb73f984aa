import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.plans import analytics, audit, dashboard, gold
from millrace.schema import METRICS_DDL
from millrace.sources import catalog
from millrace.sources.tables import read_metrics

D = dt.datetime
DDL = ("order_id string, customer_state string, order_status string, product_category string,"
       " payment_type string, quantity int, unit_price double, freight_value double,"
       " total_price double, event_ts timestamp, order_delivered_ts string,"
       " order_estimated_ts string")


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame([
        ("a", "SP", "delivered", "toys", "card", 1, 8.0, 2.0, 10.0, D(2024, 1, 1, 9),
         "2024-01-05 00:00:00", "2024-01-04 00:00:00"),
        ("b", "SP", "shipped", "toys", "card", 2, 9.0, 1.0, 20.0, D(2024, 1, 1, 9), "",
         "2024-01-04 00:00:00"),
        ("c", "RJ", "delivered", None, "boleto", 1, 5.0, 0.5, 30.0, D(2024, 1, 2, 23),
         "2024-01-03 12:00:00", "2024-01-04 00:00:00"),
        ("d", "RJ", "created", "books", "card", 1, 5.0, 0.5, 30.0, D(2024, 1, 4, 0), None, "bad"),
    ], DDL)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_daily_revenue(silver):
    days = by(gold.daily_revenue(silver), "date_key")
    first = days["20240101"]
    assert (first.total_revenue, first.order_count, first.avg_order_value) == (30.0, 2, 15.0)
    assert (first.total_freight, first.avg_freight, first.revenue_per_order) == (3.0, 1.5, 15.0)


def test_state_metrics_count_undelivered_as_not_late(silver):
    states = by(gold.state_metrics(silver), "customer_state")
    assert states["SP"].avg_delivery_delay_hrs == 24.0
    assert (states["SP"].late_deliveries, states["SP"].late_delivery_pct) == (1, 50.0)
    assert (states["RJ"].avg_delivery_delay_hrs, states["RJ"].late_deliveries) == (-12.0, 0)


def test_categories_skip_missing_and_rank_densely(silver):
    ranked = by(gold.category_performance(silver), "product_category")
    assert {c: r.revenue_rank for c, r in ranked.items()} == {"toys": 1, "books": 1}
    assert ranked["toys"].total_qty == 3


def test_trend_window_is_rows_not_days(silver):
    trend = analytics.daily_revenue_trend(gold.daily_revenue(silver)).collect()
    assert [r.revenue_7d_ma for r in trend] == [30.0, 30.0, 30.0]
    assert len(trend) == 3


def test_shares(silver):
    funnel = by(analytics.status_funnel_pct(gold.status_funnel(silver)), "order_status")
    assert funnel["delivered"].pct_of_total == 50.0
    paid = by(analytics.payment_method_breakdown(silver), "payment_type")
    assert (paid["card"].revenue_pct, paid["boleto"].revenue_pct) == (66.7, 33.3)
    # Equal counts share one running value.
    pareto = analytics.customer_concentration(gold.state_metrics(silver)).collect()
    assert [r.cumulative_pct for r in pareto] == [100.0, 100.0]
    sla = by(analytics.delivery_sla(gold.state_metrics(silver)), "customer_state")
    assert (sla["SP"].on_time, sla["SP"].on_time_pct) == (1, 50.0)
    hours = by(analytics.hourly_distribution(silver), "order_hour")
    assert hours[9].order_count == 2
    assert analytics.top_states_revenue(gold.state_metrics(silver), 1).first().customer_state == "RJ"


def test_gold_upsert_keeps_untouched_groups(spark, silver):
    before = gold.status_funnel(silver).withColumn(gold.UPDATED, F.lit(D(2024, 1, 1)))
    update = gold.status_funnel(silver.where("order_status = 'created'")).withColumn(
        "total_revenue", F.lit(99.0)).withColumn(gold.UPDATED, F.lit(D(2024, 1, 2)))
    merged = by(gold.refreshed(before, update, "order_status"), "order_status")
    assert merged["created"].total_revenue == 99.0
    assert merged["delivered"].total_revenue == 40.0


def test_catalog_suite(spark, silver, tmp_path):
    catalog.ensure_database(spark, "plans_test", str(tmp_path / "db"))
    catalog.register(silver, "orders_silver", "plans_test", str(tmp_path / "silver"))
    for name, table in gold.build_all(spark.table("plans_test.orders_silver")).items():
        catalog.register(gold.with_update_time(table), name, "plans_test", str(tmp_path / name))
    assert catalog.tables(spark, "plans_test").count() == 5
    for name in analytics.SUITE:
        assert analytics.run_report(spark, name, "plans_test").count() > 0
    # A user's own SQL reads the same tables.
    assert spark.sql("SELECT sum(order_count) FROM plans_test.gold_daily_revenue").first()[0] == 4


def test_metrics_of_both_writers(spark, tmp_path):
    lines = [
        '{"batch_id": "1", "total_records": "10", "valid_records": "8", "silver_records": "7",'
        ' "quarantine_records": "2", "duplicates_removed": "1", "valid_pct": "80.0",'
        ' "batch_duration_sec": "1.5"}',
        '{"batch_id": "2", "total_records": 20, "valid_records": "20", "silver_upserted": "20",'
        ' "quarantine_records": "0", "duplicates_removed": "0", "valid_pct": "100.0",'
        ' "batch_duration_sec": "oops"}',
        '{"batch_id": "3", "total_records": "x"}',
    ]
    (tmp_path / "m.json").write_text("\n".join(lines))
    metrics = dashboard.typed_metrics(read_metrics(spark, str(tmp_path)))
    got = by(metrics, "batch_id")
    assert [got[i].silver_records for i in (1, 2, 3)] == [7, 20, 0]
    assert got[3].total_records is None and got[2].batch_duration_sec is None
    summary = dashboard.quality_summary(metrics).first()
    assert (summary.total_records, summary.avg_valid_pct, summary.batch_count) == (30, 90.0, 3)
    assert dashboard.batch_breakdown(metrics).count() == 3


def test_empty_metrics(spark):
    empty = spark.createDataFrame([], METRICS_DDL)
    summary = dashboard.quality_summary(dashboard.typed_metrics(empty)).first()
    assert (summary.batch_count, summary.total_records, summary.avg_valid_pct) == (0, None, None)


def test_samples(silver):
    latest = audit.latest_rows(silver, [F.col("event_ts").desc(), "order_id"], ["order_id"], 2)
    assert [r.order_id for r in latest.collect()] == ["d", "c"]
    assert audit.partition_row_counts(silver, "customer_state", 1).count() == 1
    assert audit.versions_of(silver, "order_id", "a", ["event_ts"]).count() == 1
