"""Test attributes kept in the semi-structured ``testing_software`` column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Attribute name -> (path inside the variant, type).
TEST_ATTRIBUTES = {
    "device": ("$.device", "string"),
    "device_type": ("$.device_type", "string"),
    "model": ("$.model", "string"),
    "configuration": ("$.occt.stability_test.configuration", "string"),
    "length_in_minutes": ("$.occt.stability_test.length_in_minutes", "int"),
    "mode": ("$.occt.stability_test.mode", "string"),
    "load_type": ("$.occt.stability_test.load_type", "string"),
    "start_at_cycle": ("$.occt.stability_test.start_at_cycle", "int"),
    "instruction_set": ("$.occt.stability_test.instruction_set", "string"),
    "thread_settings": ("$.occt.stability_test.thread_settings", "string"),
    "thread_count": ("$.occt.stability_test.thread_count", "int"),
}


def attribute(software: Column, name: str) -> Column:
    path, data_type = TEST_ATTRIBUTES[name]
    return F.try_variant_get(software, path, data_type).alias(name)


def device_of(software: Column) -> Column:
    return F.variant_get(software, "$.device", "string")
