"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs
once to warm up and then BENCH_RUNS times, whole results being written to the
no-op sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from logsync.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINES = (
    "relay_resume_filtered",
    "relay_multi_topic",
    "relay_until_end",
    "high_watermarks",
    "gap_report",
    "target_offsets",
    "filtered_counts",
    "relayed_counts",
    "merge_mirrors",
    "reconcile",
    "replication_lag",
    "active_history",
    "write_read_back",
    "stream_relay",
)


def timed(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    spark = local_session(cores, "bench")
    seconds = {}
    for name in names:
        timed(QUERIES[name], spark, sf_dir)
        samples = [timed(QUERIES[name], spark, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(samples), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
