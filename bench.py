"""Time the catalog queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated names, or "all"; default the headline queries), BENCH_RUNS (timed runs per query,
the fastest counts; default 2).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from granary.plans.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "stock_summary", "group_summary_b", "city_stock_b", "center_rank", "stock_detail_b", "daily_summary", "monthly_summary",
    "distribution", "bank_performance", "camp_performance", "donor_roster", "standardise_codes", "dedup", "union_dedup",
    "enrich", "ledger_balance", "demand", "stock_state", "running_balance", "transfers_valid", "transfer_pairs",
    "transfer_candidates", "event_admission", "orphans", "duplicates", "kpis", "enrichment_check", "layer_metrics", "gold_vs_silver",
    "stock_at_donation", "lots_at_issue", "monthly_sketches", "ledger_cube", "ledger_differences",
)
WARM_UP = ("stock_state", "enrich", "bank_performance", "center_rank")


def run(spark: SparkSession, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or list(HEADLINE)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("granary-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP:
        run(spark, name, folder)
    times = {name: round(min(run(spark, name, folder) for _ in range(runs)), 3) for name in names}
    spark.stop()
    print(json.dumps({
        "metric": "headline_total_seconds" if not asked else "selected_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
