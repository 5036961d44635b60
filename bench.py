"""Benchmark: run the headline queries over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line.

Every query is run to the end into a no-op sink, twice; the better time counts (the first run also compiles).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tapelake.queries import QUERIES  # noqa: E402
from tapelake.session import local_session  # noqa: E402

HEADLINE = [
    "feed_day_info_trades",
    "feed_day_info_levels",
    "feed_day_info_requests",
    "missing_days",
    "exists_feed_on_day",
    "present_days",
    "scan_feed",
    "instrument_view",
    "instrument_at",
    "normalize_trades",
    "normalize_levels",
    "level_seq_sorted",
    "level_seq_large_groups",
    "dedup_trades_ts_key",
    "dedup_levels_ts_key",
    "new_levels_only",
    "merge_levels_day_key",
    "strict_conflicts",
    "validate_levels",
    "orphan_facts",
    "unnest_batch",
    "upsert_instruments",
    "ensure_dimensions",
    "download_manifest",
    "manifest_remaining",
    "outcome_summary",
    "hourly_rollup",
    "load_trades",
    "load_level_updates",
    "reload_is_noop",
    "land_raw",
    "ingest_new_files",
    "compact_cold",
    "continuous_rollup",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    for name in ("feed_day_info_requests", "level_seq_sorted", "upsert_instruments"):  # warm up, not counted
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        best = float("inf")
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
    spark.stop()
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
