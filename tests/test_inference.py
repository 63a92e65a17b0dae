from pyspark.sql.types import LongType, StringType, VariantType

from rampline.contracts import landing_schema
from rampline.sources.inference import infer_landing_schema, load_schema
from tests.fixtures import land, payload, snapshot


def test_schema_is_kept_and_widened(spark, tmp_path):
    path, location = str(tmp_path / "in"), str(tmp_path / "schema")
    assert load_schema(spark, location) == landing_schema()
    land(spark, path, payload(snapshot(1.5)), "{broken", {**payload(), "snapshots": "none"})
    assert infer_landing_schema(spark, path, location) == landing_schema()

    land(spark, path, {**payload(), "site": "a", "run": 3}, day="2026-01-03")
    widened = infer_landing_schema(spark, path, location)
    assert [field.name for field in widened] == ["metadata", "snapshots", "run", "site"]
    assert isinstance(widened["metadata"].dataType["testing_software"].dataType, VariantType)
    assert isinstance(widened["snapshots"].dataType.elementType["sensor_value"].dataType, StringType)

    land(spark, path, {**payload(), "later": True}, day="2026-01-04")
    infer_landing_schema(spark, path, location)
    assert load_schema(spark, location).fieldNames() == ["metadata", "snapshots", "run", "site", "later"]


def test_only_files_after_a_time_are_read(spark, tmp_path):
    path, location = str(tmp_path / "in"), str(tmp_path / "schema")
    land(spark, path, {**payload(), "site": "a"})
    assert infer_landing_schema(spark, path, location, since="2999-01-01T00:00:00") == landing_schema()
    assert "site" in infer_landing_schema(spark, path, location, since="2000-01-01T00:00:00").fieldNames()


def test_nested_fields_are_added(spark, tmp_path):
    path, location = str(tmp_path / "in"), str(tmp_path / "schema")
    land(spark, path, payload(snapshot(phase=2), rack={"row": "r", "at": 1.5}), {**payload(), "snapshots": ["none"]})
    found = infer_landing_schema(spark, path, location)
    assert found["snapshots"].dataType.elementType["phase"].dataType == LongType()
    assert found["metadata"].dataType["rack"].dataType.fieldNames() == ["at", "row"]
    assert infer_landing_schema(spark, path, location) == found
