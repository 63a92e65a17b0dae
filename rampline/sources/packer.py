"""Pack flat readings into landing payloads and write them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rampline.functions.timestamps import write_poll_time, write_test_date
from rampline.operators.joins import fact_join, fits_broadcast, hot_keys

# Fixed value: most readings one payload may hold.
PAYLOAD_LIMIT = 200_000

_METADATA = ("underlying_system", "testing_software", "device_id", "test_id", "test_date")
_SNAPSHOT = ("timestamp", "hardware_name", "sensor_name", "sensor_type", "sensor_value")


def payload_json(metadata: Column, snapshots: Column) -> Column:
    """One payload as a JSON line; nulls are written out."""
    payload = F.struct(metadata.alias("metadata"), snapshots.alias("snapshots"))
    return F.to_json(payload, {"ignoreNullFields": "false"})


def snapshot_struct(**fields: Column) -> Column:
    return F.struct(*(fields[name].alias(name) for name in _SNAPSHOT))


def metadata_struct(**fields: Column) -> Column:
    return F.struct(*(fields[name].alias(name) for name in _METADATA))


def pack(readings: DataFrame, tests: DataFrame, limit: int = PAYLOAD_LIMIT) -> DataFrame:
    """Payload lines of at most ``limit`` readings of one test, in poll order.

    ``readings`` has the fact columns and is unique on the fact key, ``tests``
    the test columns, one row per test. Readings of a test without a row there
    are packed with nothing but its id, so that validation names what they lack.
    The readings are range-partitioned by
    test and time, which cuts a long test into many tasks, and sorted there on
    every column, so a rerun of a task numbers its rows alike. Every run of ``limit`` consecutive rows of a task
    then closes a payload per test in it: no payload can exceed the limit, no
    test is ever gathered whole, and payloads are complete before the shuffle.
    """
    flat = readings.select("test_id", "polled_at", "hardware_name", "sensor_name", "sensor_type", "sensor_value")
    order = flat.columns
    # The position holds the task number above bit 33 and the row number below
    position = F.col("_position")
    row = position.bitwiseAND(F.lit((1 << 33) - 1))
    run = F.floor(row / F.lit(limit))
    numbered = (
        flat.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
        .select(*order, F.shiftright(position, 33).alias("_task"), run.alias("_run"))
    )
    snapshot = snapshot_struct(
        timestamp=write_poll_time(F.col("polled_at")),
        hardware_name=F.col("hardware_name"),
        sensor_name=F.col("sensor_name"),
        sensor_type=F.col("sensor_type"),
        sensor_value=F.col("sensor_value"),
    )
    chunks = numbered.groupBy("test_id", "_task", "_run").agg(
        F.array_sort(F.collect_list(snapshot)).alias("snapshots")
    )
    metadata = metadata_struct(
        underlying_system=F.col("underlying_system"),
        testing_software=F.col("testing_software"),
        device_id=F.col("device_id"),
        test_id=F.col("test_id"),
        test_date=write_test_date(F.col("tested_at")),
    )
    small = fits_broadcast(tests)
    hot = None if small else hot_keys(flat, ["test_id"])
    described = fact_join(chunks, tests, "test_id", small, hot, "left")
    return described.select(payload_json(metadata, F.col("snapshots")).alias("value"))


def write_landing(payloads: DataFrame, path: str, upload_date: Column | None = None, per_file: int = 1) -> None:
    """Append payload lines under their upload date (today unless given)."""
    dated = payloads.select("value", (F.current_date() if upload_date is None else upload_date).alias("ingest_date"))
    dated.write.mode("append").partitionBy("ingest_date").option("maxRecordsPerFile", per_file).text(path)
