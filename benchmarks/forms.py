"""Compare forms of one operator with each other, on the driver's events repeated.

Usage: python benchmarks/forms.py [sf_dir] [times]. Every event is repeated
``times`` times, and a third of all readings goes to one test, so that the forms
differ where they would on a cluster. Prints one line per form.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession, Window, functions as F  # noqa: E402

from driver import views  # noqa: E402
from rampline.contracts import FACT_COLUMNS, FACT_KEY  # noqa: E402
from rampline.naming import Layout  # noqa: E402
from rampline.operators.dedup import first_seen  # noqa: E402
from rampline.operators.gold import RAMPUP, device_mart, tests_of_device, warming_up  # noqa: E402
from rampline.operators.rules import READING_RULES, reasons, route  # noqa: E402
from rampline.operators.silver import clean, explode_readings, normalize, normalize_cleaned  # noqa: E402
from rampline.session import configure, work_folder  # noqa: E402
from rampline.sources.packer import pack, write_landing  # noqa: E402
from rampline.streaming import stages  # noqa: E402
from rampline.streaming.sinks import drain  # noqa: E402

HOT = "u1"


def repeated_fact(spark: SparkSession, sf_dir: str, times: int) -> DataFrame:
    """Distinct readings: each copy is moved by whole seconds."""
    n = F.col("n")
    return (
        views.fact(spark, sf_dir)
        .withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
        .withColumn("polled_at", F.timestamp_millis(F.unix_millis("polled_at") + n * 1000))
        .withColumn("test_id", F.when(n % 3 == 0, F.lit(HOT)).otherwise(F.col("test_id")))
        .drop("n")
    )


def report(name: str, action, runs: int = 3) -> None:
    seconds = []
    for _ in range(runs + 1):
        began = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - began)
    middle = sorted(seconds[1:])[runs // 2] if runs > 1 else seconds[-1]
    print(f"{name}: {middle:.2f} s", flush=True)


def once(name: str, action) -> None:
    began = time.perf_counter()
    action()
    print(f"{name}: {time.perf_counter() - began:.2f} s", flush=True)


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def window_mart(fact: DataFrame, tests: DataFrame, device: str) -> DataFrame:
    joined = fact.join(F.broadcast(tests_of_device(tests, device)), "test_id")
    start = F.min("polled_at").over(Window.partitionBy("test_id"))
    return joined.withColumn("thermal_rampup_phase", warming_up(F.col("polled_at"), start, RAMPUP))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    times = int(sys.argv[2]) if len(sys.argv) > 2 else 60
    spark = configure(
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = work_folder(spark, "forms")
    repeated_fact(spark, sf_dir, times).repartition(16).write.parquet(f"{folder}/fact")
    views.tests(spark, sf_dir).write.parquet(f"{folder}/tests")
    fact, tests = spark.read.parquet(f"{folder}/fact"), spark.read.parquet(f"{folder}/tests")
    print(f"readings: {fact.count()}, of the hot test: {fact.filter(F.col('test_id') == HOT).count()}", flush=True)

    device = "device_1"  # the hot test belongs to it
    report("mart, window over whole tests", lambda: noop(window_mart(fact, tests, device)))
    report("mart, minima and broadcast", lambda: noop(device_mart(fact, tests, device)))
    broadcasts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    report("mart, minima and sliced join", lambda: noop(device_mart(fact, tests, device, limit=0)))
    report("mart, minima and unsliced join", lambda: noop(device_mart(fact, tests, device, limit=0, hot_share=1.0)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)

    layout = Layout(root=f"{folder}/volumes", table_root=f"{folder}/tables")
    pipeline = stages.Pipeline(layout, "forms_bronze", "forms_silver", "forms_gold", "forms_ops")
    once("pack into payloads and land", lambda: write_landing(pack(fact, tests, 20_000), pipeline.landing_path))
    once("bronze stream", lambda: stages.run_bronze(spark, pipeline, "run"))

    bronze = spark.table(pipeline.bronze())
    accepted = clean(bronze).payloads
    exploded = explode_readings(accepted)
    report("explode and cast", lambda: noop(exploded))
    report("accepted readings, one boolean", lambda: noop(route(exploded, READING_RULES).accepted))
    by_array = exploded.withColumn("quarantine", reasons(READING_RULES)).filter("size(quarantine) = 0").drop("quarantine")
    report("accepted readings, array of reasons", lambda: noop(by_array))
    report("tests from payloads", lambda: noop(normalize_cleaned(clean(bronze)).tests))
    report("tests from readings", lambda: noop(normalize(clean(bronze).readings).tests))
    report("fact, batch deduplication", lambda: noop(normalize_cleaned(clean(bronze)).fact))

    fact_rows = clean(spark.readStream.table(pipeline.bronze())).readings.select(*FACT_COLUMNS)
    keys = list(FACT_KEY)
    sliced = fact_rows.withColumn("_slice", F.spark_partition_id() % 64).dropDuplicates([*keys, "_slice"]).drop("_slice")
    fact_forms = {
        "no combine": fact_rows.dropDuplicates(keys),
        "combined in the task": first_seen(fact_rows, keys),
        "stateful pass per slice first": sliced.dropDuplicates(keys),
    }
    for name, df in fact_forms.items():
        out = work_folder(spark, "form")
        writer = df.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint")
        once(f"fact stream, {name}", lambda w=writer, o=out: w.trigger(availableNow=True).start(f"{o}/data").awaitTermination())
        size = sum(f.stat().st_size for f in Path(out, "checkpoint").rglob("*") if f.is_file())
        print(f"  checkpoint: {size / 1e6:.0f} MB", flush=True)

    once("silver, five streams side by side", lambda: stages.run_silver(spark, pipeline))
    other = stages.Pipeline(layout, "forms_bronze", "forms_silver2", "forms_gold", "forms_ops2", mart_table="m")
    stages.drain = lambda starters: [drain([start]) for start in starters]
    once("silver, five streams in series", lambda: stages.run_silver(spark, other))
    stages.drain = drain
    once("gold", lambda: stages.run_gold(spark, pipeline, device))
    spark.stop()


if __name__ == "__main__":
    main()
