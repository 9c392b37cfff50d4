"""Time the headline queries, cold and then warm; prints one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wanderlake.registry import queries as registry  # noqa: E402
from wanderlake.session import build_session  # noqa: E402

HEADLINE = (
    "clean_flights_30s",
    "clean_policies",
    "flight_daily_stats",
    "flight_messages_accepted",
    "flight_states",
    "stg_customers",
    "stg_policies",
    "stg_claims",
    "fact_policies",
    "fact_claims",
    "revenue_by_month",
    "premium_by_destination",
    "claim_kpis",
    "average_claim_by_destination",
    "recent_claims",
    "top_brokers",
    "flights_by_country",
    "quality_report",
    "reconciliation",
    "stream_flight_ingest",
    "stream_flight_dedup",
)


def timed(run) -> float:
    began = time.perf_counter()
    run()
    return round(time.perf_counter() - began, 3)


def drain(df) -> None:
    """Compute every row and column without collecting them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    drain(spark.range(1_000))
    seconds = {"build_star": timed(lambda: registry.star_root(spark, folder))}
    warm = {}
    for name in HEADLINE:
        seconds[name] = timed(lambda: drain(registry.QUERIES[name](spark, folder)))
    for name in HEADLINE:
        warm[name] = timed(lambda: drain(registry.QUERIES[name](spark, folder)))
    spark.stop()
    line = {
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "warm": warm,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
