"""Validation rules: named faults, looked for in order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

Field = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """``fault(field)`` is true where a row breaks the rule.

    The fault is written against ``field(name)`` and not against fixed columns,
    so the same rule serves the columns of a DataFrame and the elements of an
    array inside a higher-order function.
    """

    reason: str
    fault: Callable[[Field], Column]


def missing(reason: str, name: str) -> Rule:
    return Rule(reason, lambda field: field(name).isNull())


def present(reason: str, name: str) -> Rule:
    return Rule(reason, lambda field: field(name).isNotNull())


# --- fixed values: reasons in reporting order ---

PAYLOAD_RULES = (
    missing("null_metadata", "metadata"),
    missing("null_metadata_device_id", "metadata.device_id"),
    missing("null_metadata_test_date", "metadata.test_date"),
    missing("null_metadata_test_id", "metadata.test_id"),
    Rule(
        # a JSON null is a variant value, not a missing one
        "null_metadata_testing_software",
        lambda field: field("metadata.testing_software").isNull()
        | F.is_variant_null(field("metadata.testing_software")),
    ),
    missing("null_metadata_underlying_system", "metadata.underlying_system"),
    missing("null_snapshots", "snapshots"),
    Rule("empty_snapshots", lambda field: F.size(field("snapshots")) == 0),
    present("rescued_data_present", "rescued_data"),
    present("corrupt_record_present", "corrupt_record"),
    missing("null_source_file", "source_file"),
    missing("null_execution_id", "execution_id"),
    missing("null_dbx_ingest_date", "dbx_ingest_date"),
    missing("null_adls_upload_date", "adls_upload_date"),
)

READING_RULES = (
    missing("null_test_date", "tested_at"),
    missing("null_hardware_name", "hardware_name"),
    missing("null_sensor_name", "sensor_name"),
    missing("null_sensor_type", "sensor_type"),
    Rule("nan_sensor_value", lambda field: F.isnan(field("sensor_value"))),
    missing("null_sensor_value", "sensor_value"),
    Rule("infinite_sensor_value", lambda field: F.abs(field("sensor_value")) == float("inf")),
    missing("null_polled_at", "polled_at"),
)

# --- end of fixed values ---

# Opt-in: a value that was sent but is not a number. Needs the untyped text.
NON_NUMERIC_VALUE = Rule(
    "non_numeric_sensor_value",
    lambda field: field("sensor_value_text").isNotNull()
    & field("sensor_value_text").try_cast("double").isNull(),
)


def any_fault(rules: Sequence[Rule], field: Field = F.col) -> Column:
    """True where at least one rule is broken, never null."""
    return reduce(or_, (F.coalesce(rule.fault(field), F.lit(False)) for rule in rules))


def reasons(rules: Sequence[Rule], field: Field = F.col) -> Column:
    """Array of the reasons that apply, in rule order."""
    marks = F.array(*(F.when(rule.fault(field), F.lit(rule.reason)) for rule in rules))
    return F.filter(marks, lambda mark: mark.isNotNull())


class Routed(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def route(df: DataFrame, rules: Sequence[Rule]) -> Routed:
    """Split by the rules; rejected rows carry their reasons in ``quarantine``.

    Good rows are the many. They only pay for one boolean expression, which is
    compiled with the rest of the stage and whose null checks reach the Parquet
    scan; the array of reasons is built for rejected rows alone.
    """
    fault = any_fault(rules)
    return Routed(
        accepted=df.filter(~fault),
        rejected=df.filter(fault).withColumn("quarantine", reasons(rules)),
    )
