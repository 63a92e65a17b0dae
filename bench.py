"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from driver import queries, views  # noqa: E402
from rampline.session import configure, work_folder  # noqa: E402
from rampline.sources.landing import parse_payloads  # noqa: E402

HEADLINE = (
    "landing_parse",
    "payload_reasons",
    "accepted_readings",
    "reading_reasons",
    "reasons_by_stage",
    "fct_dedup",
    "tests_dedup",
    "files_dedup",
    "lineitem_dedup",
    "lineage_join",
    "hardware_classes",
    "payload_roundtrip",
    "first_poll_per_test",
    "device_mart_10m",
    "device_mart_1d",
    "device_mart_shuffled",
    "landing_to_mart",
    "steady_state_stats",
    "efficiency_summary",
    "efficiency_compare",
)
REPEATS = 3


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def drained(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def bronze_build() -> None:
        parse_payloads(views.payload_lines(spark, sf_dir)).write.parquet(work_folder(spark, "bench"))

    registered = queries.all_queries()
    measured = {"bronze_build": bronze_build}
    for name in HEADLINE:
        measured[name] = lambda build=registered[name]: drained(build(spark, sf_dir))

    views.KEEP_TABLES = False  # no query lives on tables that another one has paid for
    seconds = {}
    for name, action in measured.items():
        action()  # warm-up
        seconds[name] = round(statistics.median(timed(action) for _ in range(REPEATS)), 3)
    # landing files through three streaming stages, three times, into tables
    runs = [timed(lambda: queries.streamed(spark, sf_dir)) for _ in range(REPEATS)]
    seconds["medallion_run"] = round(statistics.median(runs), 3)

    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
