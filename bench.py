"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     runs per batch query, of which the fastest counts (default 2)

Streams and table writes run once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerline.plans import QUERIES
from ledgerline.session import build_session

BATCH = (
    "silver_transactions",
    "silver_auth_logs",
    "silver_system_logs",
    "json_parse_transactions",
    "dedup_transactions",
    "geo_parse",
    "dq_nulls",
    "dq_duplicates",
    "pii_hash",
    "enrich_customer",
    "gold_fact_transactions",
    "gold_dim_date",
    "features_customer_daily",
    "features_rolling_24h",
    "error_rate_hourly",
    "failed_login_burst",
    "sql_silver_summary",
    "auc_exact",
)
WRITES = (
    "bronze_append",
    "silver_upsert_auth",
    "silver_upsert_system",
    "compact_same_rows",
    "stream_route_transactions",
    "stream_silver_auth",
    "stream_silver_system",
    "stream_dedup",
    "stream_late_data",
    "alerts_suspicious",
    "bi_hourly_merchant",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
        master=f"local[{cpus}]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    store = spark.sparkContext._jsc.sc().statusStore()
    took, shuffled = {}, {}
    for name in (*BATCH, *WRITES):
        timed = []
        before = store.executorSummary("driver").totalShuffleWrite()
        for _ in range(runs if name in BATCH else 1):
            timed.append(seconds(spark, name, sf_dir))
        took[name] = round(min(timed), 3)
        shuffled[name] = round((store.executorSummary("driver").totalShuffleWrite() - before) / len(timed) / 1e6, 2)
        print(f"{name} {took[name]} s, {shuffled[name]} MB shuffled", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "shuffle_mb": shuffled,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
