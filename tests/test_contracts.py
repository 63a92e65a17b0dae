import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from rampline import contracts
from rampline.operators.silver import clean, envelope
from tests.fixtures import bronze_rows, payload


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


@pytest.mark.parametrize("column", contracts.BRONZE_COLUMNS)
def test_missing_bronze_column_is_named(spark, column):
    with pytest.raises(ValueError, match=rf"missing column\(s\): {column}$"):
        clean(bronze_rows(spark, payload()).drop(column))


def test_order_and_nullability_are_free(spark):
    schema = contracts.reading_schema()
    fields = [StructField(f.name, f.dataType, False) for f in reversed(schema.fields)]
    frame = _empty(spark, StructType(fields))
    assert contracts.check_contract(frame, schema, "readings") is frame


def test_faults_are_reported(spark):
    schema = contracts.reading_schema()
    with pytest.raises(ValueError, match="lacking \\['device_id'\\]"):
        contracts.check_contract(_empty(spark, schema).drop("device_id"), schema, "readings")
    with pytest.raises(ValueError, match="surplus \\['more'\\]"):
        contracts.check_contract(_empty(spark, schema).selectExpr("*", "1 AS more"), schema, "readings")
    with pytest.raises(ValueError, match="sensor_value is string, not double"):
        text = _empty(spark, schema).withColumn("sensor_value", F.col("sensor_name"))
        contracts.check_contract(text, schema, "readings")


def test_struct_is_not_a_variant(spark):
    rows = bronze_rows(spark, payload())
    plain = rows.selectExpr(
        "named_struct('underlying_system', metadata.underlying_system, 'testing_software', named_struct('device', 'x'),"
        " 'device_id', metadata.device_id, 'test_id', metadata.test_id, 'test_date', metadata.test_date) AS metadata",
        *[name for name in rows.columns if name != "metadata"],
    )
    with pytest.raises(Exception, match="(?i)variant"):
        clean(plain)


def test_envelope(spark):
    rejected = spark.sql("SELECT array('a', NULL) AS quarantine, 1 AS x, 'y' AS y")
    packed = envelope(rejected, "batch")
    assert packed.columns == ["quarantine", "quarantined_rows", "quarantined_at", "quarantined_batch_id"]
    assert packed.schema["quarantine"].dataType == ArrayType(StringType())
    row = packed.first()
    assert row["quarantined_rows"].asDict() == {"x": 1, "y": "y"}
    assert row["quarantined_batch_id"] == "batch" and row["quarantined_at"] is not None
    with pytest.raises(ValueError, match="quarantine is array<int>"):
        envelope(spark.sql("SELECT array(1) AS quarantine, 1 AS x"), "batch")


def test_both_quarantines_share_a_batch(spark):
    bad = payload(device_id=None)
    worse = payload({"sensor_value": "x"})
    cleaned = clean(bronze_rows(spark, bad, worse))
    ids = {
        row[0]
        for frame in (cleaned.incoming_quarantine, cleaned.outgoing_quarantine)
        for row in frame.select("quarantined_batch_id").collect()
    }
    assert len(ids) == 1
