from __future__ import annotations

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from driver import views
from pyspark.sql import functions as F
from rampline.sources import inference
from rampline.sources.landing import documents, parse_payloads

EVENTS = 4_000


@pytest.fixture(scope="module")
def one_row_group(tmp_path_factory):
    """Events in a file of many splits, of which one holds all rows."""
    folder = tmp_path_factory.mktemp("events")
    ids = range(EVENTS)
    start = datetime(2024, 1, 1)
    table = pa.table(
        {
            "event_id": pa.array(ids, pa.int64()),
            "ts": pa.array([start + timedelta(minutes=number) for number in ids], pa.timestamp("us")),
            "user_id": pa.array([number % 40 for number in ids], pa.int64()),
            "event_type": ["click"] * EVENTS,
            "value": [number / 100 for number in ids],
            "props": [f'{{"k": {number}}}' for number in ids],
        }
    )
    pq.write_table(table, folder / "events.parquet", row_group_size=EVENTS)
    return str(folder)


@pytest.fixture
def small_splits(spark):
    size, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    kept = {key: spark.conf.get(key) for key in (size, cost)}
    spark.conf.set(size, "4096")
    spark.conf.set(cost, "1")
    yield
    for key, value in kept.items():
        spark.conf.set(key, value)


def _rows_of_tasks(df):
    return [row["count"] for row in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


def test_lines_are_made_in_even_tasks_whatever_the_row_groups(spark, one_row_group, small_splits):
    events = views.events(spark, one_row_group)
    assert events.rdd.getNumPartitions() > 4 and _rows_of_tasks(events) == [EVENTS]
    tasks = _rows_of_tasks(views.payload_lines(spark, one_row_group))
    assert sum(tasks) == EVENTS * 6 // 5
    assert max(tasks) < sum(tasks) / 2


def test_a_task_makes_lines_of_so_many_events(spark, one_row_group, monkeypatch):
    monkeypatch.setattr(views, "EVENTS_PER_TASK", 100)
    assert views.payload_lines(spark, one_row_group).rdd.getNumPartitions() == EVENTS // 100


def test_events_without_time_or_id_are_kept(spark, tmp_path):
    rows = spark.sql("SELECT CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS TIMESTAMP_NTZ) AS ts FROM range(10)")
    rows.write.parquet(str(tmp_path / "events"))
    assert views._in_even_tasks(spark.read.parquet(str(tmp_path / "events"))).count() == 10


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_filter_makes_the_lines_once_more(spark, one_row_group):
    lines = views.payload_lines(spark, one_row_group)
    assert "Filter" not in _plan(documents(lines)) and "Filter" not in _plan(parse_payloads(lines))


def test_blank_and_missing_lines_are_none(spark):
    lines = spark.createDataFrame([("",), (" \t\r",), (None,), ("{}",), ("[1,2]",), ("[]",)], "value string")
    assert sorted(row.value for row in documents(lines).collect()) == ["1", "2", "{}"]


def test_inference_parses_a_line_once(spark, one_row_group):
    found = inference._fields_of(parse_payloads(views.payload_lines(spark, one_row_group)))
    assert "Filter" not in _plan(found)
    assert "collector: STRING" in found.first()["found"]
