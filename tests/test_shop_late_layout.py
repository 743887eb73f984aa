import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import enrich, evolution, late, layout
from millrace.sources.tables import read_shop

HEADS = {
    "olist_orders_dataset.csv": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,"
        "order_estimated_delivery_date"),
    "olist_order_items_dataset.csv": (
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value"),
    "olist_order_payments_dataset.csv": (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value"),
    "olist_customers_dataset.csv": (
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state"),
    "olist_products_dataset.csv": (
        "product_id,product_category_name,product_name_lenght,product_description_lenght,"
        "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,"
        "product_width_cm"),
}
LINES = {
    "olist_orders_dataset.csv": [
        "o1,c1,invoiced,2017-10-02 10:56:33,,,2017-10-10 21:25:13,2017-10-18 00:00:00",
        "o2,c9,weird,2017-10-01 00:00:00,,,,2017-10-18 00:00:00",
        "o3,c1,created,,,,,",
        "o4,c1,created,2017-10-03 00:00:00,,,,"],
    "olist_order_items_dataset.csv": [
        "o1,1,p1,s1,x,10.10,1.20", "o1,2,p2,s1,x,20.00,2.00",
        "o2,1,p9,s2,x,5.555,0.10", "o3,1,p1,s1,x,1.00,1.00"],
    "olist_order_payments_dataset.csv": [
        "o1,2,voucher,1,3.30", "o1,1,card,1,30.00"],
    "olist_customers_dataset.csv": ['c1,u,0,"sao paulo, centro",SP'],
    "olist_products_dataset.csv": ["p1,toys,,,,,,,", "p2,,,,,,,,"],
}


def test_events_from_shop_files(spark, tmp_path):
    for name, head in HEADS.items():
        (tmp_path / name).write_text("\n".join([head, *LINES[name]]) + "\n")
    events = enrich.chronological(enrich.order_item_events(**read_shop(spark, str(tmp_path))))
    got = events.collect()
    # o3 has no purchase time, o4 no items.
    assert [(e.order_id, e.product_id) for e in got] == [("o2", "p9"), ("o1", "p1"), ("o1", "p2")]
    lost, first, second = got
    assert (lost.customer_state, lost.product_category, lost.payment_type) == ("unknown",) * 3
    assert (lost.order_status, lost.payment_value, lost.unit_price) == ("weird", 0.0, 5.56)
    assert lost.order_delivered_ts is None
    assert (first.order_status, first.payment_type, first.payment_value) == ("confirmed", "card", 33.3)
    assert (first.customer_city, first.total_price) == ("sao paulo, centro", 11.3)
    assert first.event_time == "2017-10-02T10:56:33Z"
    # A known product without a category is not an unknown product.
    assert second.product_category is None


def test_last_lookup_row_wins(spark):
    df = spark.createDataFrame([("p", 1, "old"), ("p", 2, "new"), ("q", 1, "only")],
                               "product_id string, seq int, name string")
    assert sorted(map(tuple, enrich.last_row(df, "product_id", "seq").collect())) == [
        ("p", "new"), ("q", "only")]


def test_hot_order_joins_whole(spark):
    orders = spark.range(50).select(
        F.col("id").alias("order_id"), (F.col("id") % 7).alias("customer_id"),
        F.lit("created").alias("order_status"),
        F.lit("2024-01-01 00:00:00").alias("order_purchase_timestamp"),
        F.lit("").alias("order_delivered_customer_date"),
        F.lit("").alias("order_estimated_delivery_date"))
    items = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("order_id"),
        (F.col("id") % 2).cast("string").alias("product_id"), F.lit("s").alias("seller_id"),
        F.lit(1.0).alias("price"), F.lit(0.5).alias("freight_value"))
    payments = spark.createDataFrame(
        [], "order_id long, payment_sequential int, payment_type string, payment_value double")
    customers = spark.createDataFrame([(1, "SP", "x")],
                                      "customer_id long, customer_state string, customer_city string")
    products = spark.createDataFrame([("1", "toys")],
                                     "product_id string, product_category_name string")
    events = enrich.order_item_events(orders, items, payments, customers, products)
    assert events.count() == 3000
    assert events.where("product_category = 'toys'").count() == 1500


def test_lateness_against_brute_force(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, i // 10, start + dt.timedelta(minutes=(i * 37) % 400 + i)) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, batch int, at timestamp")
    want, seen = {}, None
    for batch in range(8):
        mine = [r for r in rows if r[1] == batch]
        for r in mine:
            want[r[0]] = seen is not None and r[2] <= seen - dt.timedelta(hours=1)
        top = max(r[2] for r in mine)
        seen = top if seen is None else max(seen, top)
    got = late.with_lateness(df, "batch", "at", "1 HOUR").collect()
    assert {r.id: r.is_late for r in got} == want and any(want.values())
    on_time, behind = late.split_late(df, "batch", "at")
    assert on_time.count() + behind.count() == 80
    assert behind.count() == sum(want.values())


def test_rewrite_keeps_rows_and_sorts_files(spark, rows, tmp_path):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "SP").otherwise("RJ").alias("customer_state"),
        F.timestamp_seconds((F.col("id") * 7919) % 1000).alias("event_ts"),
        F.col("id").alias("order_id"))
    path = str(tmp_path / "out")
    layout.rewrite(df, path, "customer_state", ties=("order_id",), size_bytes=4 * layout.TARGET_FILE_BYTES)
    back = spark.read.parquet(path)
    assert rows(back.select(df.columns)) == rows(df)
    spans = back.groupBy("customer_state", F.col("_metadata.file_path").alias("f")).agg(
        F.min(F.struct("event_ts", "order_id")).alias("lo"),
        F.max(F.struct("event_ts", "order_id")).alias("hi")).collect()
    assert len(spans) >= 4
    for state in ("SP", "RJ"):
        ordered = sorted((s.lo, s.hi) for s in spans if s.customer_state == state)
        assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


def test_evolution_columns(spark):
    df = spark.createDataFrame([
        ("o1", "delivered", "2024-01-03 10:00:00", "2024-01-05 00:00:00"),
        ("o2", "delivered", "2024-01-06 23:00:00", "2024-01-05 00:00:00"),
        ("o3", "delivered", "", "2024-01-05 00:00:00"), ("o4", "created", None, "junk")],
        "order_id string, order_status string, order_delivered_ts string, order_estimated_ts string")
    sample = evolution.sample_to_evolve(df, 100)
    assert sample.count() == 3
    evolved = evolution.with_added_columns(sample)
    assert [r.delivery_delay_days for r in evolved.orderBy("order_id").collect()] == [-2.0, 1.0, None]
    assert all(1 <= r.review_score <= 5 for r in evolved.collect())
    table = df.join(evolved.select("order_id", *evolution.ADDED_COLUMNS), "order_id", "left")
    assert evolution.already_evolved(table) and not evolution.already_evolved(df)
    audit = {r.column_name: (r.not_null_records, r.null_records)
             for r in evolution.null_audit(table).collect()}
    assert audit == {"review_score": (3, 1), "delivery_delay_days": (2, 2)}
    report = {r.column_name: r for r in evolution.schema_report(df, table).collect()}
    assert report["review_score"].is_new and not report["order_id"].is_new
    assert report["review_score"].data_type == "int"
