import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, VariantType

from rampline.contracts import LANDING_DDL
from rampline.operators.silver import clean
from rampline.sources.landing import landing_lines, to_bronze
from tests.fixtures import land, payload, snapshot, without


def _bronze(spark, path):
    return to_bronze(landing_lines(spark, path, stream=False), "run-1")


def _keys(row):
    return json.loads(row["rescued_data"])["keys"] if row["rescued_data"] else None


def test_columns_and_audit(spark, tmp_path):
    land(spark, str(tmp_path), payload(snapshot(45.2)))
    bronze = _bronze(spark, str(tmp_path))
    assert set(bronze.columns) == {
        "metadata", "snapshots", "adls_upload_date", "rescued_data",
        "source_file", "corrupt_record", "dbx_ingest_date", "execution_id",
    }
    assert isinstance(bronze.schema["metadata"].dataType["testing_software"].dataType, VariantType)
    assert isinstance(bronze.schema["adls_upload_date"].dataType, DateType)
    row = bronze.first()
    assert str(row["adls_upload_date"]) == "2026-01-02"
    assert row["source_file"].startswith("file:") and "ingest_date=2026-01-02" in row["source_file"]
    assert row["execution_id"] == "run-1" and row["dbx_ingest_date"] is not None
    assert row["corrupt_record"] is None and row["rescued_data"] is None
    assert row["snapshots"][0]["sensor_value"] == "45.2"


def test_malformed_lines_are_kept_whole(spark, tmp_path):
    good = json.dumps(payload())
    broken = [good[:-1], good[: len(good) // 2], "{" + good, "not json"]
    land(spark, str(tmp_path), *broken)
    rows = _bronze(spark, str(tmp_path)).collect()
    assert {row["corrupt_record"] for row in rows} == set(broken)
    assert all(row["rescued_data"] is None for row in rows)


def test_wrong_shapes_are_rescued(spark, tmp_path):
    documents = [{**payload(), "snapshots": "none"}, {**payload(), "metadata": "none"}]
    land(spark, str(tmp_path), *documents)
    rows = _bronze(spark, str(tmp_path)).collect()
    assert all(row["corrupt_record"] is None for row in rows)
    kept = [json.loads(json.loads(row["rescued_data"])["line"]) for row in rows]
    assert sorted(kept, key=str) == sorted(documents, key=str)
    assert sorted((row["metadata"] is None, row["snapshots"] is None) for row in rows) == [(False, True), (True, False)]


def test_unexpected_keys_are_rescued(spark, tmp_path):
    top = {**payload(test_id="top"), "extra": 1}
    inner = payload(test_id="inner", firmware="f")
    both = {**payload(test_id="both", firmware="f"), "extra": 1}
    nested = payload(snapshot(more=1), test_id="nested")
    land(spark, str(tmp_path), top, inner, both, nested, payload(test_id="none"))
    found = {row["metadata"]["test_id"]: _keys(row) for row in _bronze(spark, str(tmp_path)).collect()}
    assert found == {
        "top": ["extra"],
        "inner": ["metadata.firmware"],
        "both": ["extra", "metadata.firmware"],
        "nested": ["snapshots.more"],
        "none": None,
    }


def test_rescued_line_is_whole(spark, tmp_path):
    document = {**payload(), "extra": {"a": [1, 2]}}
    land(spark, str(tmp_path), document)
    rescued = json.loads(_bronze(spark, str(tmp_path)).first()["rescued_data"])
    assert json.loads(rescued["line"]) == document


def test_bare_non_finite_tokens_reach_their_rules(spark, tmp_path):
    tokens = [snapshot(float(text)) for text in ("nan", "inf", "-inf")]
    land(spark, str(tmp_path), json.dumps(payload(*tokens, snapshot("1"))))
    bronze = _bronze(spark, str(tmp_path))
    row = bronze.first()
    assert row["corrupt_record"] is None and row["rescued_data"] is None
    bronze.write.parquet(str(tmp_path / "bronze"))
    cleaned = clean(spark.read.parquet(str(tmp_path / "bronze")))
    reasons = sorted(row[0] for row in cleaned.outgoing_quarantine.select("quarantine").collect())
    assert reasons == [["infinite_sensor_value"], ["infinite_sensor_value"], ["nan_sensor_value"]]
    assert cleaned.readings.count() == 1


def test_missing_parts_are_null(spark, tmp_path):
    land(spark, str(tmp_path), without(payload(), "snapshots"), without(payload(), "metadata"))
    rows = _bronze(spark, str(tmp_path)).collect()
    assert sorted((row["metadata"] is None, row["snapshots"] is None) for row in rows) == [(False, True), (True, False)]
    assert all(row["corrupt_record"] is None for row in rows)


def test_json_is_parsed_once(spark, tmp_path):
    land(spark, str(tmp_path), payload())
    plan = _bronze(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(metadata") == 1


def test_unexpected_keys_beside_a_bare_nan_are_rescued(spark, tmp_path):
    odd = {**payload(snapshot(float("nan"), more=1), firmware="f"), "extra": 1}
    land(spark, str(tmp_path), json.dumps(odd))
    assert _keys(_bronze(spark, str(tmp_path)).first()) == ["extra", "metadata.firmware", "snapshots.more"]


def test_one_wrong_element_keeps_the_line(spark, tmp_path):
    document = payload()
    document["snapshots"].insert(0, 5)
    land(spark, str(tmp_path), document)
    row = _bronze(spark, str(tmp_path)).first()
    assert row["corrupt_record"] is None and json.loads(json.loads(row["rescued_data"])["line"]) == document


@pytest.mark.parametrize(
    "line",
    [
        json.dumps(payload()) + " trailing",
        json.dumps(payload()) + "]",
        json.dumps(payload()) + "}",
        json.dumps(payload()) + ",",
        json.dumps(payload()) + ', {"a": 1}',
        json.dumps(payload()) + ",0",
        json.dumps(payload()) + "] [0",
        json.dumps(payload(snapshot(float("nan")))) + " trailing",
        json.dumps(payload()).replace('"snapshots"', '"snapshots": [], "snapshots"'),
        json.dumps(payload()).replace('"hardware_name"', '"hardware_name": "h", "hardware_name"'),
        json.dumps(payload(snapshot(float("nan")))).replace('"hardware_name"', '"hardware_name": "h", "hardware_name"'),
        json.dumps(payload()).replace('"device_id"', '"device_id": "d", "device_id"'),
    ],
)
def test_repeated_keys_and_what_follows_are_rescued(spark, tmp_path, line):
    land(spark, str(tmp_path), line)
    (row,) = _bronze(spark, str(tmp_path)).collect()
    assert row["corrupt_record"] is None
    rescued = json.loads(row["rescued_data"])
    assert rescued["line"] == line and rescued["lossy"] and "mistyped" not in rescued


def test_an_array_with_text_after_it_is_kept_whole(spark, tmp_path):
    line = json.dumps([payload()]) + " more"
    land(spark, str(tmp_path), line)
    assert [row["corrupt_record"] for row in _bronze(spark, str(tmp_path)).collect()] == [line]


def test_lenient_lines_lose_nothing(spark, tmp_path):
    land(spark, str(tmp_path), json.dumps(payload()).replace('"', "'"))
    row = _bronze(spark, str(tmp_path)).first()
    assert row["rescued_data"] is None and row["corrupt_record"] is None and row["metadata"]["test_id"] == "t1"


def test_null_readings_are_readings(spark, tmp_path):
    document = payload()
    document["snapshots"].append(None)
    land(spark, str(tmp_path), document)
    row = _bronze(spark, str(tmp_path)).first()
    assert row["rescued_data"] is None and row["snapshots"][-1] is None and len(row["snapshots"]) == 2


def test_values_are_read_as_they_were_sent(spark, tmp_path):
    sent = {"3": 3, "1.5": 1.5, "true": True, "x": "x", '{"a":1}': {"a": 1}, "[1]": [1], None: None}
    land(spark, str(tmp_path), payload(*(snapshot(value) for value in sent.values())))
    row = _bronze(spark, str(tmp_path)).first()
    assert row["rescued_data"] is None
    assert [reading["sensor_value"] for reading in row["snapshots"]] == list(sent)


def test_fields_of_the_wrong_type_are_rescued(spark, tmp_path):
    schema = StructType.fromDDL(LANDING_DDL.replace("sensor_value: string", "sensor_value: string, phase: int") + ", site int")
    right, wrong = payload(snapshot(phase=3), test_id="right"), payload(snapshot(phase="x"), test_id="wrong")
    top = {**payload(test_id="top"), "site": "five"}
    land(spark, str(tmp_path), {**right, "site": 5}, wrong, top)
    rows = to_bronze(landing_lines(spark, str(tmp_path), stream=False), "run-1", schema).collect()
    found = {row["metadata"]["test_id"]: (row["snapshots"][0]["phase"], row["site"], _keys(row)) for row in rows}
    assert found == {"right": (3, 5, None), "wrong": (None, None, ["snapshots.phase"]), "top": (None, None, [])}


def test_blank_lines_and_arrays(spark, tmp_path):
    first, second = payload(test_id="a"), payload(test_id="b")
    land(spark, str(tmp_path), json.dumps([first, second]), " \t", "[]", "[7]", "[null]", "[broken", payload(test_id="c"))
    rows = _bronze(spark, str(tmp_path)).collect()
    assert sorted(row["metadata"]["test_id"] for row in rows if row["metadata"]) == ["a", "b", "c"]
    assert sorted(row["corrupt_record"] for row in rows if row["corrupt_record"]) == ["7", "[broken", "null"]
    assert len(rows) == 6


def test_old_files_are_not_skipped(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stream = to_bronze(landing_lines(spark, path), "run-1")
        writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        writer.trigger(availableNow=True).start(out).awaitTermination()
        return spark.read.parquet(out).count()

    land(spark, path, payload(test_id="a"))
    assert run() == 1
    before = set((tmp_path / "in").rglob("*.*"))
    land(spark, path, payload(test_id="late"), day="2025-12-01")
    for file in set((tmp_path / "in").rglob("*.*")) - before:
        if file.is_file():
            os.utime(file, (1_000_000_000, 1_000_000_000))
    assert run() == 2


def test_stream_reads_the_same(spark, tmp_path):
    path = str(tmp_path / "in")
    land(spark, path, payload(test_id="a"), day="2026-01-02")
    land(spark, path, payload(test_id="b"), "oops", day="2026-01-03")
    stream = to_bronze(landing_lines(spark, path), "run-1")
    out = str(tmp_path / "out")
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    days = {row[0]: row[1] for row in spark.read.parquet(out).groupBy(F.col("adls_upload_date").cast("string")).count().collect()}
    assert days == {"2026-01-02": 1, "2026-01-03": 2}
