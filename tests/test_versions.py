"""The versioned table against a brute-force reading of its definition."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import versions
from millrace.operators.versions import Versioning
from millrace.plans import audit

V = Versioning(keys=("k",), event_time="at", commit="c", ties=("x",))
DDL = "k int, at int, c long, x int"


def make_log(seed, n=120):
    rng = random.Random(seed)
    made, seen = [], set()
    for x in range(n):
        row = (rng.randint(0, 14), rng.choice([None, *range(12)]), rng.randint(1, 8), x)
        if row[:3] not in seen:  # ties inside one commit are settled by x alone
            seen.add(row[:3])
            made.append(row)
    return made


def newest(log):
    best = {}
    for row in log:
        rank = (row[1] is not None, row[1] or 0, row[2], -row[3])
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    return sorted((row for _, row in best.values()), key=repr)


@pytest.fixture(params=[1, 2, 3])
def log(request):
    return make_log(request.param)


def test_as_of_and_snapshot(spark, rows, log):
    df = spark.createDataFrame(log, DDL)
    assert rows(versions.snapshot(df, V)) == newest(log)
    for commit in (1, 4, 8):
        want = newest(r for r in log if r[2] <= commit)
        assert rows(versions.as_of(df, V, commit)) == want


def test_changes(spark, rows, log):
    df = spark.createDataFrame(log, DDL)
    for after, until in ((0, None), (2, 5), (3, 4), (7, None), (8, None)):
        state = newest(r for r in log if until is None or r[2] <= until)
        want = sorted((r for r in state if r[2] > after), key=repr)
        assert rows(versions.changes(df, V, after, until)) == want


def test_changes_complete_an_earlier_state(spark, rows, log):
    df = spark.createDataFrame(log, DDL)
    early, delta = versions.as_of(df, V, 3), versions.changes(df, V, 3, 6)
    assert rows(versions.merge_latest(early, delta, V)) == rows(versions.as_of(df, V, 6))


def test_pairs_equal_single_reads(spark, log):
    df = spark.createDataFrame(log, DDL)
    survivors = sorted({r[2] for r in newest(log)})
    want = {}
    for begin, end in zip(survivors, survivors[1:]):
        state = newest(r for r in log if r[2] <= end)
        want[begin, end] = sum(r[2] > begin for r in state)
    got = versions.changes_per_commit_pair(df, V).collect()
    assert {(r.begin_commit, r.end_commit): r.records for r in got} == {
        pair: n for pair, n in want.items() if n}


def test_merge_is_the_same_for_any_split(spark, rows, log):
    df = spark.createDataFrame(log, DDL)
    for cut in (2, 5):
        base = versions.as_of(df, V, cut)
        assert rows(versions.merge_latest(base, df.where(F.col("c") > cut), V)) == newest(log)


def test_ties_decide_whichever_side_a_row_comes_from(spark, rows):
    low = spark.createDataFrame([(1, 5, 2, 10)], DDL)
    high = spark.createDataFrame([(1, 5, 2, 11)], DDL)
    for base, delta in ((low, high), (high, low)):
        assert rows(versions.merge_latest(base, delta, V)) == [(1, 5, 2, 10)]


def test_timelines(spark, log):
    df = spark.createDataFrame(log, DDL)
    owned = {}
    for row in newest(log):
        owned[row[2]] = owned.get(row[2], 0) + 1
    assert {r.c: r.records for r in versions.surviving_commits(df, V).collect()} == owned
    full = versions.commit_counts(df, V).collect()
    assert sum(r.records for r in full) == len(log)


def test_retained_history_answers_the_last_commits(spark, rows, log):
    df = spark.createDataFrame(log, DDL)
    commits = sorted({r[2] for r in log})
    short = versions.keep_last_commits(df, V, 3)
    assert short.count() < len(log)
    for commit in commits[-3:]:
        assert rows(versions.as_of(short, V, commit)) == rows(versions.as_of(df, V, commit))
    with pytest.raises(ValueError):
        versions.keep_last_commits(df, V, 0)


def test_audits(spark, log):
    df = spark.createDataFrame(log, DDL)
    state = newest(log)
    first = min(r[2] for r in state)
    growth = audit.time_travel_growth(df, V).first()
    assert growth.early_records == len(newest(r for r in log if r[2] <= first))
    assert growth.late_records == len(state)
    saved = audit.incremental_reduction(df, V).first()
    assert saved.full_records == len(state)
    assert saved.incremental_records == sum(r[2] > first for r in state)
    stats = audit.table_stats(versions.snapshot(df, V), V, "x").first()
    assert (stats.total_rows, stats.commits) == (len(state), len({r[2] for r in state}))
    audits = {r.layer: r for r in audit.duplicate_audit(
        {"log": df.select("k"), "now": versions.snapshot(df, V).select("k")}, "k").collect()}
    assert audits["now"].duplicate_rows == 0
    assert audits["log"].duplicate_rows == len(log) - len({r[0] for r in log})


def test_version_history(spark, log):
    df = spark.createDataFrame(log, DDL)
    counts = {}
    for row in log:
        counts[row[0]] = counts.get(row[0], 0) + 1
    winner = {r[0]: r for r in newest(log)}
    got = audit.version_history(df, V, ["at", "x"]).collect()
    assert len(got) == sum(n for n in counts.values() if n > 1)
    assert all(r.versions == counts[r.k] and r.current_x == winner[r.k][3] for r in got)
    top = audit.most_updated_key(df, "k").first()
    assert top.versions == max(counts.values())


def test_bucketed_base_is_not_shuffled(spark, rows, tmp_path, log):
    from millrace.sources import catalog
    df = spark.createDataFrame(log, DDL)
    df.write.parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    catalog.ensure_database(spark, "buckets_test", str(tmp_path / "db"))
    name = f"base_{abs(hash(str(tmp_path)))}"
    catalog.register_bucketed(
        versions.as_of(stored, V, 4), name, "k", 4, "buckets_test", str(tmp_path / "base"))
    base = spark.table(f"buckets_test.{name}")
    merged = versions.merge_into_buckets(base, stored.where("c > 4"), V, 4)
    assert rows(merged.select("k", "at", "c", "x")) == newest(log)
    text = merged._jdf.queryExecution().executedPlan().toString()
    scan = next(i for i, line in enumerate(text.splitlines()) if "Bucketed: true" in line)
    above = text.splitlines()[:scan]
    assert not any("Exchange" in line for line in above)
