"""Table contracts and the checks that enforce them before any data moves."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, TimestampType

# --- fixed values: names and types of the landing, bronze and silver contracts ---

# sensor_value stays text so that one bad reading fails alone, not its payload.
LANDING_DDL = """
    metadata struct<
        underlying_system: string,
        testing_software: variant,
        device_id: string,
        test_id: string,
        test_date: string>,
    snapshots array<struct<
        timestamp: string,
        hardware_name: string,
        sensor_name: string,
        sensor_type: string,
        sensor_value: string>>
"""

CORRUPT_COLUMN = "corrupt_record"
RESCUED_COLUMN = "rescued_data"

BRONZE_COLUMNS = (
    "metadata",
    "snapshots",
    "adls_upload_date",
    "rescued_data",
    "source_file",
    "corrupt_record",
    "dbx_ingest_date",
    "execution_id",
)

READING_DDL = """
    device_id string,
    test_id string,
    tested_at timestamp,
    testing_software variant,
    underlying_system string,
    hardware_name string,
    sensor_name string,
    sensor_type string,
    sensor_value double,
    polled_at timestamp,
    dbx_ingested_at timestamp,
    adls_upload_date date,
    source_file string,
    execution_id string
"""

FACT_COLUMNS = (
    "test_id",
    "hardware_name",
    "sensor_name",
    "sensor_type",
    "sensor_value",
    "polled_at",
    "source_file",
)
FACT_KEY = ("test_id", "hardware_name", "sensor_name", "sensor_type", "polled_at")

TESTS_COLUMNS = ("test_id", "tested_at", "device_id", "testing_software", "underlying_system")
TESTS_KEY = ("test_id",)

FILES_COLUMNS = ("source_file", "adls_upload_date", "execution_id", "dbx_ingested_at")
FILES_KEY = ("source_file",)

MART_COLUMNS = (
    "test_id",
    "tested_at",
    "device_id",
    "testing_software",
    "hardware_name",
    "sensor_name",
    "sensor_type",
    "sensor_value",
    "polled_at",
    "thermal_rampup_phase",
)

# --- end of fixed values ---


def landing_schema() -> StructType:
    return StructType.fromDDL(LANDING_DDL)


def reading_schema() -> StructType:
    return StructType.fromDDL(READING_DDL)


def quarantine_schema(rejected_row: StructType) -> StructType:
    """Envelope around whatever row was rejected."""
    return StructType(
        [
            StructField("quarantine", ArrayType(StringType())),
            StructField("quarantined_rows", rejected_row),
            StructField("quarantined_at", TimestampType()),
            StructField("quarantined_batch_id", StringType()),
        ]
    )


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    absent = sorted(set(names).difference(df.columns))
    if absent:
        raise ValueError(f"missing column(s): {', '.join(absent)}")
    return df


def check_contract(df: DataFrame, expected: StructType, label: str) -> DataFrame:
    """Same column set and exactly the same types; order and nullability are free."""
    actual = {field.name: field.dataType for field in df.schema}
    wanted = {field.name: field.dataType for field in expected}
    if actual.keys() != wanted.keys():
        lacking = sorted(wanted.keys() - actual.keys())
        surplus = sorted(actual.keys() - wanted.keys())
        raise ValueError(f"{label}: columns differ from the contract (lacking {lacking}, surplus {surplus})")
    wrong = sorted(name for name, data_type in wanted.items() if actual[name] != data_type)
    if wrong:
        detail = ", ".join(f"{name} is {actual[name].simpleString()}, not {wanted[name].simpleString()}" for name in wrong)
        raise ValueError(f"{label}: {detail}")
    return df
