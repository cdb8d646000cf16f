"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query's result is counted through the no-op sink, so every column is computed and nothing is collected.
The first run of a query warms code paths; the better of the following runs counts. The ordered operators run once more
with chunks of CHUNK rows (names with ``@chunks``), so that every partition spans many chunks and carries between them.
"""

from __future__ import annotations

import json
import os
import time

from tidelog.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

CHUNK = int(os.environ.get("BENCH_CHUNK", "4000"))
ORDERED = ["as_log", "batches", "done_watermark", "idle_periods", "pause_intervals", "fence_zombies", "counter_rate", "retry_in_place",
           "judge_acks", "nack", "append_then_read_log"]

HEADLINE = [
    "as_log", "key_partition", "partition_spread", "moved_keys", "hot_keys", "delivery_audit", "delivery_audit_lineitem",
    "bounds", "last_n", "replay_from_time", "done_watermark", "stop_at_failure", "batches", "lag", "skip_handled",
    "read_committed", "visibility_report", "run_summary", "rank_percentile", "metric_table", "idle_periods", "pause_intervals",
    "fence_zombies", "dedup_retries", "rebalance_cost", "outage_timeline", "counter_rate", "decode_orders_good", "route_by_type",
    "wire_header", "schema_compat", "retry_in_place", "retry_topics", "dead_letters", "queue_worker", "queue_state_short_lock",
    "process_in_order", "append_then_read_log", "stream_exactly_once", "stream_effectively_once",
]


def main() -> None:
    spark = build_session(CPUS, "tidelog-bench", shuffle_partitions=int(CPUS))
    from tidelog import workloads
    from tidelog.queries import QUERIES

    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    times = {}
    for name in names:
        best = None
        for run in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if run > 0 or RUNS == 1:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    if not os.environ.get("BENCH_QUERIES"):
        workloads.QUERY_CHUNK = CHUNK
        for name in ORDERED:
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times[f"{name}@chunks"] = round(time.perf_counter() - start, 3)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(t for n, t in times.items() if "@" not in n), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": CPUS, "events": events,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
