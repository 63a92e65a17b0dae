import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rampline.operators.silver import clean, normalize_cleaned
from rampline.sources.landing import landing_lines, to_bronze
from rampline.sources import packer
from rampline.sources.packer import pack, write_landing
from tests.test_gold import _tests


def _fact(spark, n):
    i = F.col("id")
    return spark.range(0, n, 1, 5).select(
        F.when(i % 2 == 0, F.lit("t0")).otherwise(F.concat(F.lit("t"), i % 5)).alias("test_id"),
        F.lit("CPU /amdcpu/0").alias("hardware_name"),
        F.concat(F.lit("s"), i % 3).alias("sensor_name"),
        F.lit("Power").alias("sensor_type"),
        (i * 0.5).alias("sensor_value"),
        F.timestamp_millis(F.lit(1_767_000_000_000) + i).alias("polled_at"),
    )


def _dimension(spark):
    return _tests(spark, {f"t{n}": "box" for n in range(5)}).withColumn("underlying_system", F.lit("monitor"))


@pytest.mark.parametrize("limit", [1, 7, 10_000])
def test_no_payload_exceeds_the_limit_and_none_mixes_tests(spark, limit):
    lines = [json.loads(row[0]) for row in pack(_fact(spark, 300), _dimension(spark), limit).collect()]
    sizes = [len(line["snapshots"]) for line in lines]
    assert sum(sizes) == 300 and max(sizes) <= limit
    for line in lines:
        stamps = [s["timestamp"] for s in line["snapshots"]]
        assert stamps == sorted(stamps)
        assert list(line["metadata"]) == ["underlying_system", "testing_software", "device_id", "test_id", "test_date"]
    if limit == 10_000:
        # one payload per test and task
        assert len(lines) <= 5 + 4


def test_round_trip_through_the_landing_directory(spark, tmp_path):
    fact = _fact(spark, 200)
    lines = pack(fact, _dimension(spark), 50)
    write_landing(lines, str(tmp_path / "in"), F.lit("2026-01-02").cast("date"))
    files = list(Path(tmp_path / "in" / "ingest_date=2026-01-02").glob("*.txt"))
    assert len(files) == lines.count()  # one payload per file
    to_bronze(landing_lines(spark, str(tmp_path / "in"), stream=False), "run").write.parquet(str(tmp_path / "bronze"))
    tables = normalize_cleaned(clean(spark.read.parquet(str(tmp_path / "bronze"))))
    columns = fact.columns
    assert sorted(map(str, tables.fact.select(columns).collect())) == sorted(map(str, fact.collect()))
    assert tables.tests.count() == 5
    assert str(tables.tests.selectExpr("variant_get(testing_software, '$.device', 'string')").first()[0]) == "box"


def test_upload_date_defaults_to_today(spark, tmp_path):
    write_landing(spark.createDataFrame([("{}",)], "value string"), str(tmp_path / "in"))
    dated = landing_lines(spark, str(tmp_path / "in"), stream=False)
    assert dated.select(F.col("ingest_date") == F.current_date()).first()[0]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_readings_without_a_test_are_packed(spark, monkeypatch, limit):
    monkeypatch.setattr(packer, "fits_broadcast", lambda tests: limit > 0)
    lines = pack(_fact(spark, 50), _dimension(spark).filter("test_id <> 't0'"), 7)
    found = [json.loads(row[0]) for row in lines.collect()]
    assert sum(len(line["snapshots"]) for line in found) == 50
    lacking = {line["metadata"]["device_id"] for line in found if line["metadata"]["test_id"] == "t0"}
    assert lacking == {None}
