import json

import pytest

from rampline.operators.rules import PAYLOAD_RULES, READING_RULES, any_fault, reasons, route
from rampline.operators.silver import explode_readings
from tests.fixtures import bronze_rows, payload, snapshot, without

PAYLOAD_CASES = [
    (payload(), {}, []),
    (without(payload(), "metadata", "device_id"), {}, ["null_metadata_device_id"]),
    (payload(test_date=None), {}, ["null_metadata_test_date"]),
    (payload(test_id=None), {}, ["null_metadata_test_id"]),
    (payload(testing_software=None), {}, ["null_metadata_testing_software"]),
    (without(payload(), "metadata", "testing_software"), {}, ["null_metadata_testing_software"]),
    (payload(underlying_system=None), {}, ["null_metadata_underlying_system"]),
    (without(payload(), "snapshots"), {}, ["null_snapshots"]),
    ({**payload(), "snapshots": []}, {}, ["empty_snapshots"]),
    (payload(), {"rescued_data": "'x'"}, ["rescued_data_present"]),
    (payload(), {"corrupt_record": "'x'"}, ["corrupt_record_present"]),
    (payload(), {"source_file": "CAST(NULL AS string)"}, ["null_source_file"]),
    (payload(), {"execution_id": "CAST(NULL AS string)"}, ["null_execution_id"]),
    (payload(), {"dbx_ingest_date": "CAST(NULL AS timestamp)"}, ["null_dbx_ingest_date"]),
    (payload(), {"adls_upload_date": "CAST(NULL AS date)"}, ["null_adls_upload_date"]),
    (
        without(payload(), "metadata"),
        {},
        [
            "null_metadata",
            "null_metadata_device_id",
            "null_metadata_test_date",
            "null_metadata_test_id",
            "null_metadata_testing_software",
            "null_metadata_underlying_system",
        ],
    ),
    ({"metadata": {**payload()["metadata"], "device_id": None}, "snapshots": []}, {}, ["null_metadata_device_id", "empty_snapshots"]),
    # blank text and strange dates are not payload faults
    (payload(device_id="", test_date="never"), {}, []),
    ({**payload(), "snapshots": [None]}, {}, []),
]


@pytest.mark.parametrize("document, overrides, expected", PAYLOAD_CASES)
def test_payload_rules(spark, document, overrides, expected):
    rows = bronze_rows(spark, document, **overrides)
    found = rows.select(reasons(PAYLOAD_RULES).alias("r"), any_fault(PAYLOAD_RULES).alias("f")).first()
    assert found["r"] == expected
    assert found["f"] is bool(expected)


READING_CASES = [
    (snapshot(), []),
    (snapshot(hardware_name=None), ["null_hardware_name"]),
    (snapshot(sensor_name=None), ["null_sensor_name"]),
    (snapshot(sensor_type=None), ["null_sensor_type"]),
    (snapshot("NaN"), ["nan_sensor_value"]),
    (snapshot("invalid"), ["null_sensor_value"]),
    (snapshot(None), ["null_sensor_value"]),
    (snapshot("Infinity"), ["infinite_sensor_value"]),
    (snapshot("-Infinity"), ["infinite_sensor_value"]),
    (snapshot("inf"), ["infinite_sensor_value"]),
    (snapshot(41.5), []),
    (snapshot(7), []),
    (snapshot(" 1.5 "), []),
    (snapshot(timestamp="yesterday"), ["null_polled_at"]),
    (snapshot(timestamp=None), ["null_polled_at"]),
    (snapshot("x", None, sensor_name=None), ["null_sensor_name", "null_sensor_value", "null_polled_at"]),
    (None, ["null_hardware_name", "null_sensor_name", "null_sensor_type", "null_sensor_value", "null_polled_at"]),
]


def test_reading_rules(spark):
    for element, expected in READING_CASES:
        readings = explode_readings(bronze_rows(spark, {**payload(), "snapshots": [element]}))
        assert readings.select(reasons(READING_RULES)).first()[0] == expected, element


def test_unreadable_test_date_fails_each_reading(spark):
    readings = explode_readings(bronze_rows(spark, payload(snapshot(), snapshot("x"), test_date="never")))
    found = [row[0] for row in readings.select(reasons(READING_RULES)).collect()]
    assert found == [["null_test_date"], ["null_test_date", "null_sensor_value"]]


def test_routing_agrees_with_reasons(spark):
    documents = [json.loads(json.dumps(case[0])) for case in PAYLOAD_CASES]
    rows = bronze_rows(spark, *documents)
    accepted, rejected = route(rows, PAYLOAD_RULES)
    by_reasons = rows.withColumn("quarantine", reasons(PAYLOAD_RULES))
    assert accepted.count() == by_reasons.filter("size(quarantine) = 0").count()
    assert accepted.columns == rows.columns
    wanted = sorted(map(str, (row[0] for row in by_reasons.filter("size(quarantine) > 0").select("quarantine").collect())))
    assert sorted(map(str, (row[0] for row in rejected.select("quarantine").collect()))) == wanted


def test_null_checks_reach_the_scan(spark, tmp_path, capsys):
    bronze_rows(spark, payload()).write.parquet(str(tmp_path / "b"))
    accepted = route(spark.read.parquet(str(tmp_path / "b")), PAYLOAD_RULES).accepted
    accepted.explain("formatted")
    plan = capsys.readouterr().out
    assert "IsNotNull(metadata.device_id)" in plan and "IsNull(corrupt_record)" in plan
