"""Time the headline queries; prints one JSON line.

Every query runs once to warm up and is then timed over ``BENCH_RUNS`` runs, of
which the median counts. A run writes the whole result to Spark's ``noop`` sink, so no
column or row can be optimised away and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from millrace.checks import queries
from millrace.session import build_session, scratch_dir
from millrace.streaming.medallion import Layers

HEADLINE = [
    # quality and layers
    "qc_flags", "quarantine_reasons", "batch_quality_metrics", "dedup_latest_per_key",
    "silver_layer_batch_dedup", "bronze_layer", "upsert_audit",
    # versioned table
    "snapshot_latest", "time_travel_as_of", "incremental_between", "incremental_per_commit",
    "upsert_latest_wins", "commit_timeline", "order_version_history", "history_retention",
    "evolve_schema",
    # gold and analytics
    "gold_daily_revenue", "gold_state_metrics", "gold_status_funnel",
    "gold_category_performance", "daily_revenue_trend", "top_states_revenue",
    "payment_method_breakdown", "hourly_distribution", "customer_concentration",
    # shop tables, parsing, lateness
    "enriched_order_events", "payments_per_order", "parse_json_events", "late_event_split",
]


def time_ingest(spark, folder: str, versioned: bool) -> float:
    """The streaming pipeline over all events, in three batches. The messages
    are there before the clock starts, as they would be in a topic."""
    path = scratch_dir(spark, "wire")
    queries._stage(spark, folder, path)
    for _ in range(2):  # the first run warms up
        root = scratch_dir(spark, "lake")
        started = time.perf_counter()
        queries._ingest(spark, path, Layers(root), f"{root}/checkpoint", versioned)
        taken = time.perf_counter() - started
    return taken


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.log.level": "ERROR",
    })
    times = {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            queries.REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken[1:]), 3)
    ingest = {}
    if chosen is HEADLINE:
        ingest = {f"stream_ingest_{kind}": round(time_ingest(spark, folder, kind == "versioned"), 3)
                  for kind in ("append", "versioned")}
    times.update(ingest)
    result = {
        "metric": "total time of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }
    if ingest:
        events = spark.read.parquet(f"{folder}/lineitem.parquet").count()
        result["ingest_events_per_sec"] = {k: round(events / v) for k, v in ingest.items()}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
