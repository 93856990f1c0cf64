"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the median counts. With
BENCH_SQL=1 the SQL of the same query is timed in DuckDB beside it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from profile_lake.plans.catalog import ORACLES, QUERIES
from profile_lake.session import local_session

HEADLINE = [
    "collected_records",
    "ttl_dedup",
    "parse_listings",
    "last_attempts",
    "enrich_profiles",
    "row_outcomes",
    "stored_profiles",
    "hourly_trend",
    "daily_trend",
    "statement_summary",
    "slowest_queries",
    "duration_regression",
    "correlate_runs",
    "backoff_schedule",
    "poll_durations",
    "compact_seen",
]


def median_seconds(run, runs: int) -> float:
    run()
    taken = []
    for _ in range(runs):
        started = time.perf_counter()
        run()
        taken.append(time.perf_counter() - started)
    return statistics.median(taken)


def sql_seconds(sf_dir: str, names: list[str], runs: int) -> dict[str, float]:
    import duckdb

    db = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            db.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{sf_dir}/{file}'")
    return {
        n: round(median_seconds(lambda n=n: db.execute(ORACLES[n]).fetchall(), runs), 3)
        for n in names
        if n in ORACLES
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    taken = {}
    for name in names:
        # The noop sink runs the whole query without moving the result to Python.
        def run(fn=QUERIES[name]):
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

        taken[name] = round(median_seconds(run, runs), 3)
    line = {
        "metric": "total median query time",
        "value": round(sum(taken.values()), 3),
        "unit": "sec",
        "queries": taken,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cpus,
    }
    if os.environ.get("BENCH_SQL"):
        line["duckdb"] = sql_seconds(sf_dir, names, runs)
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
