"""Payloads and rows that the tests share."""

from __future__ import annotations

import copy
import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from rampline.contracts import LANDING_DDL

BRONZE_DDL = (
    LANDING_DDL
    + """, adls_upload_date date, rescued_data string, source_file string, corrupt_record string,
    dbx_ingest_date timestamp, execution_id string"""
)


def snapshot(value="40.0", timestamp="20260102_030405006", **changes) -> dict:
    base = {
        "timestamp": timestamp,
        "hardware_name": "CPU /amdcpu/0",
        "sensor_name": "Package",
        "sensor_type": "Power",
        "sensor_value": value,
    }
    return {**base, **changes}


def payload(*snapshots: dict, test_id="t1", device="box", **metadata) -> dict:
    described = {
        "underlying_system": "monitor",
        "testing_software": {"device": device},
        "device_id": "d1",
        "test_id": test_id,
        "test_date": "20260102_030400",
        **metadata,
    }
    return {"metadata": described, "snapshots": list(snapshots) or [snapshot()]}


def without(document: dict, *path: str) -> dict:
    changed = copy.deepcopy(document)
    inner = changed
    for key in path[:-1]:
        inner = inner[key]
    inner.pop(path[-1])
    return changed


def land(spark: SparkSession, path: str, *documents: dict | str, day="2026-01-02") -> None:
    lines = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(f"{path}/ingest_date={day}")


def bronze_rows(spark: SparkSession, *documents: dict, **overrides: str) -> DataFrame:
    """Bronze rows as a table would hold them; overrides are SQL expressions."""
    lines = [(json.dumps(d),) for d in documents]
    parsed = spark.createDataFrame(lines, "value string").select(F.from_json("value", LANDING_DDL).alias("p"))
    columns = {
        "adls_upload_date": F.lit("2026-01-02").cast("date"),
        "rescued_data": F.lit(None).cast("string"),
        "source_file": F.lit("file:/a.json"),
        "corrupt_record": F.lit(None).cast("string"),
        "dbx_ingest_date": F.lit(datetime(2026, 1, 2, 4)).cast("timestamp"),
        "execution_id": F.lit("run"),
    }
    columns.update({name: F.expr(sql) for name, sql in overrides.items()})
    return parsed.select("p.*", *(column.alias(name) for name, column in columns.items()))
