"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_SCRATCH = "/tmp/checkpoints"

RUNTIME_SETTINGS = {
    # The wire format marks UTC with a literal 'Z'.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session for jobs of this package; a cluster's own defaults stay in force."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = {
        **RUNTIME_SETTINGS,
        # Keyed streaming state may outgrow the heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **settings,
    }
    for name, value in options.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else has made."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files: they go when the write ends, not when the driver
    next collects its memory, so that a job of many writes needs the disk of one. For writes
    only: a result that is read twice would be shuffled twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` for written intermediates.

    Every executor must see it. Only a session that lives in one process may
    leave the setting out; it gets ``LOCAL_SCRATCH``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{LOCAL_SCRATCH}/{spark.sparkContext.applicationId}"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
