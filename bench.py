"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_RUNS how
often each query runs (the best run counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changeflow.session import build_session  # noqa: E402

HEADLINE = [
    "pv_uv_daily", "pv_uv_hourly", "messages_to_daily_pv_uv", "count_distinct_grouped",
    "predicate_scan", "range_scan", "chunks_even", "chunks_uneven", "key_violations",
    "json_explode_roundtrip", "envelope_normalize", "envelope_images", "changed_columns",
    "trace_full", "cookie_user", "compact", "materialize", "upsert_update_keep_delete",
    "upsert_insert_keep_delete", "op_upsert", "place_value", "write_sharded", "write_partitioned",
    "write_copy_text", "write_quarantine", "write_batched", "stream_json_topic", "stream_pv_uv",
    "stream_dedupe", "stream_upsert", "upsert_few_changes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    from changeflow.plans.catalog import RUNS

    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            RUNS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
