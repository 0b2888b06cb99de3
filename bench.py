"""Time the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Names on the command line restrict the run. Every query is planned and run in full with its rows
thrown away, once to warm the JVM on the smallest data and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridewright.checks.queries import QUERIES  # noqa: E402
from ridewright.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "parse_messages",
    "ride_summary",
    "rider_balance",
    "payment_requests",
    "settlement_fold",
    "settlement_union",
    "daily_vehicle_stats",
    "daily_owner_stats",
    "stats_backfill",
    "telemetry_merge",
    "geohash_neighbours",
    "proximity_search",
    "command_ack",
    "payment_choice",
    "vehicle_lifecycle",
    "upsert_latest",
    "invoice_rows",
    "windowed_stream",
]


def run(spark, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, names[0])
    times = {name: round(run(spark, name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
