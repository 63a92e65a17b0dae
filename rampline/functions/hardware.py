"""Hardware identity: ``"<name> <identifier path>"``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# First step of the identifier path, per class. Classes that are
# polled: processors, two makes of graphics card, memory.
HARDWARE_CLASSES = {
    "cpu": ("cpu", "amdcpu", "intelcpu", "genericcpu"),
    "gpu_amd": ("gpu-amd", "atigpu"),
    "gpu_nvidia": ("gpu-nvidia", "nvidiagpu"),
    "memory": ("ram", "vram", "memory"),
}


def hardware_label(name: Column, identifier: Column) -> Column:
    return F.concat_ws(" ", name, identifier)


def identifier_of(label: Column) -> Column:
    """The path behind the name, null where there is none."""
    return F.when(label.contains(" /"), F.concat(F.lit("/"), F.substring_index(label, " /", -1)))


def model_of(label: Column) -> Column:
    """The name before the path."""
    path = F.coalesce(F.length(identifier_of(label)) + 1, F.lit(0))
    return F.left(label, F.length(label) - path)


def class_of(identifier: Column) -> Column:
    """Name of the hardware class, null for classes that are not polled."""
    pairs = [(step, name) for name, steps in HARDWARE_CLASSES.items() for step in steps]
    classes = F.create_map(*(F.lit(part) for pair in pairs for part in pair))
    return F.try_element_at(classes, F.split_part(identifier, F.lit("/"), F.lit(2)))


def of_class(readings: DataFrame, *classes: str) -> DataFrame:
    """Readings of the given hardware classes (all polled classes by default)."""
    unknown = set(classes) - HARDWARE_CLASSES.keys()
    if unknown:
        raise ValueError(f"unknown hardware class(es): {sorted(unknown)}")
    named = readings.withColumn("hardware_class", class_of(identifier_of(F.col("hardware_name"))))
    return named.filter(F.col("hardware_class").isin(*(classes or HARDWARE_CLASSES)))
