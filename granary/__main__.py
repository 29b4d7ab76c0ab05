"""Run the layered job: ``spark-submit -m granary LAKE_ROOT [--as-of DAY] [--input-gb SIZE] [--no-stream]``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from granary.plans.layers import Lake, run_all
from granary.policy import DEFAULT_POLICY
from granary.sources.files import folder_bytes
from granary.tuning import GIB, settings


def main(arguments: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="granary")
    parser.add_argument("root", help="folder with raw/ and streaming/landing/; the layers are written beside them")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today(), help="the day taken as today")
    parser.add_argument("--input-gb", type=float, help="size of the raw data, for the shuffle width; measured if not given")
    parser.add_argument("--no-stream", action="store_true", help="leave the landing folder alone")
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("granary").getOrCreate()
    size = int(chosen.input_gb * GIB) if chosen.input_gb is not None else folder_bytes(spark, f"{chosen.root.rstrip('/')}/raw")
    for key, value in settings(size, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)
    policy = replace(DEFAULT_POLICY, as_of=chosen.as_of)
    overall = run_all(spark, Lake(chosen.root), policy, with_stream=not chosen.no_stream).orderBy("section").collect()
    for row in overall:
        print(f"{row['section']:<20} {row['status']:<8} {row['failed_checks']}")
    return int(any(row["section"] == "OVERALL" and row["status"] == "FAIL" for row in overall))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
