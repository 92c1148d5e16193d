"""Time the headline queries and print one JSON line.

Each query is run to the end through the no-op sink: one warm-up, then the median of
``BENCH_RUNS`` (default 3) runs, or of fewer once a query has taken ``BENCH_SECONDS``
(default 10). Sink and file queries also write to the scratch area.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerspark.session import build_session  # noqa: E402
from ledgerspark.testbed.queries import QUERIES  # noqa: E402

HEADLINE = (
    "monthly_partner_premiums",
    "monthly_partner_premiums_by_currency",
    "transaction_quality",
    "dim_partner",
    "fct_transaction",
    "parse_event_time",
    "day_coverage",
    "content_dedupe",
    "impacted_files",
    "check_unique",
    "bronze_rebuild",
    "table_upsert_by_month",
    "json_ingest",
    "warehouse_checks",
    "end_to_end_from_files",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_of(spark, name: str, sf_dir: str, runs: int, seconds: float) -> float:
    run_once(spark, name, sf_dir)
    times: list[float] = []
    while len(times) < runs and sum(times) < seconds:
        times.append(run_once(spark, name, sf_dir))
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = float(os.environ.get("BENCH_SECONDS", "10"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {}
    for name in names:
        queries[name] = median_of(spark, name, sf_dir, runs, seconds)
        print(f"{name}: {queries[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_median_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "runs": runs,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
