"""Silver: validated, typed, one row per reading; rejects in an envelope."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from rampline import contracts
from rampline.functions.timestamps import read_poll_time, read_test_date
from rampline.operators.dedup import DEFAULT_SPREAD, first_seen
from rampline.operators.rules import NON_NUMERIC_VALUE, PAYLOAD_RULES, READING_RULES, any_fault, route


# How the JSON parser spells bare non-finite tokens in a text field.
NON_FINITE_TOKENS = ('"NaN"', '"Infinity"', '"-Infinity"')


def value_text(snapshot: Column) -> Column:
    """The value as it was sent, without the quotes the parser adds to a bare NaN."""
    text = snapshot["sensor_value"]
    return F.when(text.isin(*NON_FINITE_TOKENS), F.btrim(text, F.lit('"'))).otherwise(text)


def reading_columns(snapshot: Column) -> dict[str, Column]:
    """Typed columns of one element of ``snapshots``; what cannot be cast is null."""
    text = {name: snapshot[name].try_cast("string") for name in ("hardware_name", "sensor_name", "sensor_type")}
    return {
        **text,
        "sensor_value": value_text(snapshot).try_cast("double"),
        "polled_at": read_poll_time(snapshot["timestamp"]),
    }


def payload_columns() -> dict[str, Column]:
    """Columns every reading inherits from its payload."""
    return {
        "device_id": F.col("metadata.device_id"),
        "test_id": F.col("metadata.test_id"),
        "tested_at": read_test_date(F.col("metadata.test_date")),
        "testing_software": F.col("metadata.testing_software"),
        "underlying_system": F.col("metadata.underlying_system"),
        "dbx_ingested_at": F.col("dbx_ingest_date"),
        "adls_upload_date": F.col("adls_upload_date"),
        "source_file": F.col("source_file"),
        "execution_id": F.col("execution_id"),
    }


def explode_readings(payloads: DataFrame, keep_text: bool = False) -> DataFrame:
    """One typed row per reading.

    The payload's leaf columns are picked before the explode, so that the scan
    reads only the leaves that the rest of the query uses. Readings are typed
    inside the array: a filter on a typed column cannot move below the explode
    and parse the text again. ``keep_text`` adds the value as it was sent.
    """
    inherited = payload_columns()

    def typed(snapshot: Column) -> Column:
        columns = reading_columns(snapshot)
        if keep_text:
            columns["sensor_value_text"] = value_text(snapshot)
        return F.struct(*(column.alias(name) for name, column in columns.items()))

    lifted = payloads.select(
        *(column.alias(name) for name, column in inherited.items()),
        F.explode(F.transform("snapshots", typed)).alias("snapshot"),
    )
    return lifted.select(*inherited, "snapshot.*")


def envelope(rejected: DataFrame, batch_id: str) -> DataFrame:
    """Pack everything but the reasons into one struct and stamp it."""
    row = [name for name in rejected.columns if name != "quarantine"]
    packed = rejected.select(
        "quarantine",
        F.struct(*row).alias("quarantined_rows"),
        F.current_timestamp().alias("quarantined_at"),
        F.lit(batch_id).alias("quarantined_batch_id"),
    )
    expected = contracts.quarantine_schema(StructType([rejected.schema[name] for name in row]))
    return contracts.check_contract(packed, expected, "quarantine")


class Cleaned(NamedTuple):
    """``payloads`` are the accepted payloads that ``readings`` was exploded from."""

    readings: DataFrame
    incoming_quarantine: DataFrame
    outgoing_quarantine: DataFrame
    payloads: DataFrame


def clean(bronze: DataFrame, batch_id: str | None = None, strict_numbers: bool = False) -> Cleaned:
    """Validate payloads, explode and type their readings, validate those.

    ``strict_numbers`` names a sent but non-numeric value as such, next to the
    null it becomes.
    """
    contracts.require_columns(bronze, contracts.BRONZE_COLUMNS)
    batch_id = batch_id or str(uuid.uuid4())

    payloads = route(bronze, PAYLOAD_RULES)
    rules = (*READING_RULES, NON_NUMERIC_VALUE) if strict_numbers else READING_RULES
    readings = route(explode_readings(payloads.accepted, keep_text=strict_numbers), rules)
    accepted = readings.accepted.drop("sensor_value_text")
    rejected = readings.rejected.drop("sensor_value_text")

    return Cleaned(
        readings=contracts.check_contract(accepted, contracts.reading_schema(), "readings"),
        incoming_quarantine=envelope(payloads.rejected, batch_id),
        outgoing_quarantine=envelope(rejected, batch_id),
        payloads=payloads.accepted,
    )


class Normalized(NamedTuple):
    fact: DataFrame
    tests: DataFrame
    files: DataFrame


def normalize(readings: DataFrame, spread: int = DEFAULT_SPREAD) -> Normalized:
    """Fact and dimensions from accepted readings."""
    return Normalized(
        fact=_keyed(readings, contracts.FACT_COLUMNS, contracts.FACT_KEY, spread),
        tests=_keyed(readings, contracts.TESTS_COLUMNS, contracts.TESTS_KEY, spread),
        files=_keyed(readings, contracts.FILES_COLUMNS, contracts.FILES_KEY, spread),
    )


def normalize_cleaned(cleaned: Cleaned, spread: int = DEFAULT_SPREAD, within: str | None = None) -> Normalized:
    """Same tables, with the dimensions taken from payloads.

    A payload carries up to hundreds of thousands of readings that all agree on
    the dimension columns. Asking whether a payload has *an* accepted reading
    keeps the dimension rows identical and shuffles one row per payload where
    :func:`normalize` shuffles one per reading. A stream that is told ``within`` what time
    copies come forgets their keys after it; see :func:`first_seen`.
    """
    rows = unkeyed(cleaned)
    return Normalized(
        fact=first_seen(rows.fact, contracts.FACT_KEY, spread, within),
        tests=first_seen(rows.tests, contracts.TESTS_KEY, spread, within),
        files=first_seen(rows.files, contracts.FILES_KEY, spread, within),
    )


def unkeyed(cleaned: Cleaned) -> Normalized:
    """The rows of the same tables before copies are dropped."""
    described = payloads_with_readings(cleaned.payloads)
    return Normalized(
        fact=cleaned.readings.select(*contracts.FACT_COLUMNS),
        tests=described.select(*contracts.TESTS_COLUMNS),
        files=described.select(*contracts.FILES_COLUMNS),
    )


def payloads_with_readings(payloads: DataFrame) -> DataFrame:
    """Inherited columns of the payloads that have at least one accepted reading."""
    inherited = payload_columns()

    def accepted(snapshot: Column) -> Column:
        columns = {**inherited, **reading_columns(snapshot)}
        return ~any_fault(READING_RULES, columns.__getitem__)

    return payloads.filter(F.exists("snapshots", accepted)).select(
        *(column.alias(name) for name, column in inherited.items())
    )


def _keyed(df: DataFrame, columns: tuple[str, ...], key: tuple[str, ...], spread: int) -> DataFrame:
    return first_seen(df.select(*columns), key, spread)
