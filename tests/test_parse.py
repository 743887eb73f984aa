import json

from pyspark.sql import functions as F

from millrace.functions.columns import (
    blank_to_null, normalize_status, shop_time_to_event_time,
)
from millrace.operators.parse import parse_events
from millrace.schema import BRONZE_COLUMNS, EVENT_FIELDS, QUARANTINE_COLUMNS, SILVER_COLUMNS
from millrace.sources.envelope import to_messages

ENVELOPE = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


def parsed(spark, *texts):
    rows = [("k", text, "orders", 0, i, None) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, ENVELOPE)
    return parse_events(df).orderBy("kafka_offset").collect()


def test_layer_widths():
    assert len(EVENT_FIELDS) == 18
    assert (len(BRONZE_COLUMNS), len(SILVER_COLUMNS), len(QUARANTINE_COLUMNS)) == (27, 22, 33)


def test_whole_event(spark):
    text = json.dumps({
        "order_id": "o1", "quantity": 2, "total_price": 9.5, "event_time": "2018-01-02T03:04:05Z",
        "processing_time": "2018-01-02T03:04:06.123456Z", "unknown_field": 1})
    (event,) = parsed(spark, text)
    assert (event.order_id, event.quantity, event.total_price) == ("o1", 2, 9.5)
    assert str(event.event_ts) == "2018-01-02 03:04:05"
    assert str(event.processing_ts) == "2018-01-02 03:04:06.123456"
    assert event.json_str == text


def test_broken_payloads_stay_as_rows(spark):
    got = parsed(spark, "no json", '{"order_id": "o1", "quanti', None, "[]",
                 '{"order_id": "o2", "quantity": "many", "unit_price": 1.0}')
    assert len(got) == 5
    assert [e.order_id for e in got] == [None, None, None, None, "o2"]
    assert got[4].quantity is None and got[4].unit_price == 1.0


def test_bad_times_are_null_not_errors(spark):
    times = ["", "2018-13-45T00:00:00Z", "2018/01/02", "2018-01-02T03:04:05Z"]
    got = parsed(spark, *(json.dumps({"event_time": t, "processing_time": t}) for t in times))
    assert [e.event_ts is None for e in got] == [True, True, True, False]
    assert all(e.processing_ts is None for e in got)


def test_message_round_trip_keeps_nulls(spark):
    events = spark.createDataFrame([("o1", None, 3), ("o2", "", None)],
                                   "order_id string, product_category string, quantity int")
    messages = to_messages(events)
    assert [json.loads(r.value) for r in messages.orderBy("key").collect()] == [
        {"order_id": "o1", "product_category": None, "quantity": 3},
        {"order_id": "o2", "product_category": "", "quantity": None}]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("approved", "2017-10-02 10:56:33"), ("odd", ""), (None, None)],
                               "status string, at string")
    got = df.select(normalize_status("status"), blank_to_null("at"),
                    shop_time_to_event_time("at")).collect()
    assert [r[0] for r in got] == ["confirmed", "odd", None]
    assert [r[1] for r in got] == ["2017-10-02 10:56:33", None, None]
    assert got[0][2] == "2017-10-02T10:56:33Z"
    assert df.select(F.count_if(normalize_status("status") == "confirmed")).first()[0] == 1
