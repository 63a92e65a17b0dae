import pytest
from pyspark.sql import functions as F

from rampline.functions import hardware
from rampline.functions.timestamps import read_poll_time, read_test_date, write_poll_time, write_test_date
from rampline.functions.variants import TEST_ATTRIBUTES
from rampline.plans.efficiency import test_attributes as attributes_of


def test_timestamps_round_trip_and_truncate(spark):
    row = (
        spark.sql("SELECT timestamp '2026-01-02 03:04:05.987999' AS at")
        .select(write_poll_time(F.col("at")).alias("poll"), write_test_date(F.col("at")).alias("test"))
        .first()
    )
    assert tuple(row) == ("20260102_030405987", "20260102_030405")
    back = spark.createDataFrame([tuple(row)], "poll string, test string").select(
        read_poll_time(F.col("poll")).cast("string"), read_test_date(F.col("test")).cast("string")
    )
    assert tuple(back.first()) == ("2026-01-02 03:04:05.987", "2026-01-02 03:04:05")


@pytest.mark.parametrize("text", ["", "20260102", "20261302_030405006", "20260230_030405006", "x20260102_030405006", None])
def test_unreadable_times_are_null(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(read_poll_time(F.col("t")), read_test_date(F.col("t"))).first()
    assert row[0] is None and row[1] is None


def test_hardware_labels(spark):
    cases = {
        "AMD Ryzen AI 9 HX 370 /amdcpu/0": ("AMD Ryzen AI 9 HX 370", "/amdcpu/0", "cpu"),
        "Intel Core /intelcpu/0": ("Intel Core", "/intelcpu/0", "cpu"),
        "AMD Radeon 890M /gpu-amd/0": ("AMD Radeon 890M", "/gpu-amd/0", "gpu_amd"),
        "GeForce RTX /gpu-nvidia/0": ("GeForce RTX", "/gpu-nvidia/0", "gpu_nvidia"),
        "Intel Arc /gpu-intel/0": ("Intel Arc", "/gpu-intel/0", None),
        "Generic Memory /ram": ("Generic Memory", "/ram", "memory"),
        "Board /lpc/nct6798d": ("Board", "/lpc/nct6798d", None),
        "CPU": ("CPU", None, None),
    }
    rows = spark.createDataFrame([(label,) for label in cases], "hardware_name string")
    label = F.col("hardware_name")
    identifier = hardware.identifier_of(label)
    found = rows.select("hardware_name", hardware.model_of(label), identifier, hardware.class_of(identifier)).collect()
    assert {row[0]: tuple(row)[1:] for row in found} == cases
    assert hardware.of_class(rows).count() == 5
    assert hardware.of_class(rows, "gpu_amd", "gpu_nvidia").count() == 2
    with pytest.raises(ValueError, match="unknown hardware class"):
        hardware.of_class(rows, "fan")


def test_attributes_of_incomplete_settings(spark):
    tests = spark.sql("""
        SELECT 't' AS test_id, 'd' AS device_id, parse_json('{"device":"x","occt":{"stability_test":{"thread_count":24}}}')
          AS testing_software
        UNION ALL SELECT 'u', 'd', parse_json('"text"')
        UNION ALL SELECT 'v', 'd', parse_json('{"occt":{"stability_test":{"thread_count":"many"}}}')
    """)
    found = {row["test_id"]: row for row in attributes_of(tests).collect()}
    assert set(found["t"].asDict()) == {"test_id", "device_id", *TEST_ATTRIBUTES}
    assert (found["t"]["device"], found["t"]["thread_count"], found["t"]["mode"]) == ("x", 24, None)
    assert found["u"]["device"] is None and found["v"]["thread_count"] is None
