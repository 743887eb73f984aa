"""A keyed table with history, read from a change log.

The change log is a DataFrame of all accepted row versions, each with the
commit that brought it. The newest version of a key is the one with the
greatest event time; among equal event times the later commit wins. A late
row with an older event time therefore never replaces a newer one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.latest import latest_per_key, newest_first


@dataclass(frozen=True)
class Versioning:
    """Which columns identify a row, order its versions and name its commit.

    Keys are never NULL: rows without one do not pass the quality rules.
    """

    keys: tuple[str, ...]
    event_time: str
    commit: str = "_commit_time"
    ties: tuple[str, ...] = ()

    def order(self) -> list[Column]:
        return newest_first(self.event_time, self.commit, ties=self.ties)


def snapshot(log: DataFrame, v: Versioning) -> DataFrame:
    """The current row of every key."""
    return latest_per_key(log, v.keys, v.order())


def as_of(log: DataFrame, v: Versioning, commit) -> DataFrame:
    """The table as it was right after ``commit``. ``commit`` is a value or a
    column, so a scalar subquery works too; the filter prunes commit folders."""
    return snapshot(log.where(F.col(v.commit) <= _literal(commit)), v)


def changes(log: DataFrame, v: Versioning, after, until=None) -> DataFrame:
    """Rows of the state at ``until`` (default: now) written after ``after``.

    Only the versions in the range are ranked. Of everything older, one event
    time per key is enough to tell whether a late row in the range had already
    been overtaken, so the old part is read two columns wide and shrunk to a
    row per key before its shuffle.
    """
    if until is not None:
        log = log.where(F.col(v.commit) <= _literal(until))
    recent = snapshot(log.where(F.col(v.commit) > _literal(after)), v)
    settled_before = (
        log.where(F.col(v.commit) <= _literal(after))
        .groupBy(*v.keys).agg(F.max(v.event_time).alias("_held_time"))
        .withColumnsRenamed({key: f"_held_{key}" for key in v.keys})
    )
    same_key = [F.col(key) == F.col(f"_held_{key}") for key in v.keys]
    overtaken = F.col("_held_time") > F.col(v.event_time)
    missing_time = F.col("_held_time").isNotNull() & F.col(v.event_time).isNull()
    return recent.join(settled_before, [*same_key, overtaken | missing_time], "left_anti")


def changes_per_commit_pair(log: DataFrame, v: Versioning) -> DataFrame:
    """Row count of ``changes(a, b)`` for every two successive commits a, b that
    still own a current row, in one query instead of one read per pair.

    Versions are first reduced to one per key and commit. Walking through a
    key's commits, a version becomes current when nothing before it is newer;
    a key counts for a pair when that happens anywhere between the two.
    """
    per_commit = log.groupBy(*v.keys, v.commit).agg(F.max(v.event_time).alias("_time"))
    earlier = (
        Window.partitionBy(*v.keys).orderBy(v.commit)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.max("_time").over(earlier)
    became_current = before.isNull() | (F.col("_time") >= before)
    current = per_commit.select("*", became_current.alias("_current")).where("_current")

    # A key's last version to become current is its current row. From here on
    # there is one row per commit.
    owner = current.groupBy(*v.keys).agg(F.max(v.commit).alias(v.commit))
    surviving = owner.select(v.commit).distinct().withColumn("_surviving", F.col(v.commit))
    timeline = log.select(v.commit).distinct().join(surviving, v.commit, "left")
    by_commit = Window.orderBy(v.commit)
    slots = timeline.select(
        v.commit,
        F.max("_surviving").over(by_commit.rowsBetween(Window.unboundedPreceding, -1))
        .alias("begin_commit"),
        F.min("_surviving").over(by_commit.rowsBetween(0, Window.unboundedFollowing))
        .alias("end_commit"),
    ).where("begin_commit IS NOT NULL AND end_commit IS NOT NULL")
    return (
        current.join(slots, v.commit)
        .groupBy("begin_commit", "end_commit")
        .agg(F.countDistinct(*v.keys).alias("records"))
    )


def owning_commits(log: DataFrame, v: Versioning) -> DataFrame:
    """Per key its first commit and the commit that owns its current row. Reads
    keys and times only and combines before the shuffle."""
    newest = F.max(F.struct(F.col(v.event_time).alias("at"), F.col(v.commit).alias("commit")))
    return (
        log.groupBy(*v.keys)
        .agg(F.min(v.commit).alias("first_commit"), newest.alias("_newest"))
        .select(*v.keys, "first_commit", F.col("_newest.commit").alias("owner"))
    )


def surviving_commits(log: DataFrame, v: Versioning) -> DataFrame:
    """Commits that still own a current row, with the number of such rows."""
    owners = owning_commits(log, v).select(F.col("owner").alias(v.commit))
    return commit_counts(owners, v)


def commit_counts(rows: DataFrame, v: Versioning) -> DataFrame:
    """Rows per commit; over the log itself this is the full timeline."""
    return rows.groupBy(v.commit).agg(F.count("*").alias("records"))


def merge_latest(base: DataFrame, delta: DataFrame, v: Versioning) -> DataFrame:
    """Upsert: ``base`` holds one row per key, ``delta`` any number of versions.

    The order of versions decides, ties included, whichever side a row comes
    from. Both sides send at most one row per key and task. Columns that only
    one side has are NULL on the other.
    """
    return snapshot(base.unionByName(delta, allowMissingColumns=True), v)


def merge_into_buckets(
    base: DataFrame, delta: DataFrame, v: Versioning, buckets: int
) -> DataFrame:
    """Upsert into a base read from a table bucketed by the key.

    Only the delta moves, one row per key, to where its bucket is read; the base
    is neither shuffled nor broadcast to. The union keeps the common
    partitioning, so ranking the at most two rows of a key needs no exchange.
    """
    newest = snapshot(delta, v).repartition(buckets, *v.keys)
    return snapshot(base.unionByName(newest, allowMissingColumns=True), v)


def keep_last_commits(log: DataFrame, v: Versioning, commits: int) -> DataFrame:
    """Shrink the log to what the last ``commits`` commits can be asked for.

    Everything up to the oldest retained commit becomes one row per key, which
    keeps the commit it was written by; younger versions stay as they are.
    """
    if commits < 1:
        raise ValueError("at least the current commit has to be kept")
    cut = (
        log.select(v.commit).distinct()
        .orderBy(F.col(v.commit).desc()).limit(commits)
        .agg(F.min(v.commit)).scalar()
    )
    return as_of(log, v, cut).unionByName(log.where(F.col(v.commit) > cut))


def _literal(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
