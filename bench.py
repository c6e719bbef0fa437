"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores. Every query runs once cold and
twice warm; ``queries`` holds the better warm time, ``cold`` the first run. The whole
result is produced and discarded by the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallybridge.checks.queries import REGISTRY  # noqa: E402
from tallybridge.session import build_session  # noqa: E402

HEADLINE = [
    "global_metrics",
    "gap_filled_view",
    "clean_transactions",
    "transactions_agg",
    "missing_usd_rates",
    "parse_transactions",
    "raw_dedup",
    "raw_replay_noop",
    "raw_append",
    "backfill_range",
    "partition_replace",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in HEADLINE:
        cold[name] = run(spark, name, sf_dir)
        warm[name] = min(run(spark, name, sf_dir) for _ in range(2))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, warm wall time",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
