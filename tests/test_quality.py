import datetime as dt

from millrace.operators import quality
from millrace.schema import QC_FLAGS

NOW = dt.datetime(2024, 5, 1, 12)
DDL = ("order_id string, order_status string, customer_state string, quantity int,"
       " total_price double, event_ts timestamp")
GOOD = ("a", "created", "SP", 1, 10.0, NOW)


def spoil(**changes):
    names = ["order_id", "order_status", "customer_state", "quantity", "total_price", "event_ts"]
    return tuple(changes.get(n, v) for n, v in zip(names, GOOD))


CASES = [
    GOOD,
    spoil(order_id=None), spoil(event_ts=None),
    spoil(order_status="lost"), spoil(order_status=None), spoil(order_status=""),
    spoil(customer_state="XX"), spoil(customer_state=None), spoil(customer_state=""),
    spoil(quantity=0), spoil(quantity=None), spoil(total_price=0.0), spoil(total_price=None),
    spoil(order_status=None, quantity=0),
]


def test_flags_keep_nulls_and_verdict_does_not(spark):
    checked = quality.with_quality_flags(spark.createDataFrame(CASES, DDL)).collect()
    assert [r.is_valid for r in checked] == [True] + [False] * (len(CASES) - 1)
    assert checked[4].qc_valid_status is None
    assert checked[5].qc_valid_status is False
    assert checked[1].qc_has_order_id is False


def test_split_loses_no_row(spark, rows):
    checked = quality.with_quality_flags(spark.createDataFrame(CASES, DDL))
    both = quality.valid_rows(checked).unionAll(quality.quarantined_rows(checked))
    assert rows(both) == rows(checked)


def test_three_valued_counts(spark):
    counts = quality.three_valued_counts(spark.createDataFrame(CASES, DDL)).collect()
    # One of the missing values comes with a plain violation, which decides.
    assert {r.verdict: r.records for r in counts} == {"true": 1, "false": 9, "unknown": 4}


def test_reasons_add_up(spark):
    checked = quality.with_quality_flags(spark.createDataFrame(CASES, DDL))
    reasons = quality.rejection_reasons(quality.quarantined_rows(checked))
    assert set(QC_FLAGS) < set(reasons.columns)
    assert sum(r.records for r in reasons.collect()) == len(CASES) - 1


def test_batch_figures_and_running_totals(spark):
    table = spark.createDataFrame(
        [(1, *GOOD), (1, *GOOD), (1, *spoil(quantity=0)), (2, *GOOD), (3, *spoil(quantity=0))],
        "batch_id int, " + DDL)
    per_batch = quality.batch_quality(quality.with_quality_flags(table), "batch_id")
    got = {r.batch_id: r for r in quality.with_running_totals(per_batch).collect()}
    assert (got[1].total_records, got[1].valid_records, got[1].silver_records) == (3, 2, 1)
    assert (got[1].valid_pct, got[1].dedup_pct) == (66.67, 50.0)
    # Nothing valid: no division by zero.
    assert (got[3].valid_pct, got[3].dedup_pct) == (0.0, 0.0)
    assert (got[3].cumulative_total, got[3].cumulative_silver, got[3].cumulative_batches) == (5, 2, 3)


def test_batch_figures_without_grouping(spark):
    checked = quality.with_quality_flags(spark.createDataFrame(CASES, DDL))
    assert quality.batch_quality(checked).first().total_records == len(CASES)
