"""Steady-state questions asked of the device mart.

Which sensor means what is data, not code: callers pass a mapping with the
columns ``hardware_name, sensor_name, metric, core, core_type``, where
``metric`` is ``power`` or ``clock``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from rampline.functions.variants import TEST_ATTRIBUTES, attribute
from rampline.operators.joins import fact_join, fits_broadcast
from rampline.plans.percentiles import exact_percentiles
from rampline.session import work_folder

_MAPPING_KEY = ["hardware_name", "sensor_name"]


def steady_state(mart: DataFrame) -> DataFrame:
    return mart.filter(~F.col("thermal_rampup_phase"))


def test_attributes(tests: DataFrame, names: Sequence[str] = tuple(TEST_ATTRIBUTES)) -> DataFrame:
    """The nested settings of each test as plain columns."""
    software = F.col("testing_software")
    return tests.select("test_id", "device_id", *(attribute(software, name) for name in names))


def core_readings(mart: DataFrame, mapping: DataFrame) -> DataFrame:
    """Readings whose sensor the mapping names, labelled by it."""
    return fact_join(mart, mapping, _MAPPING_KEY, fits_broadcast(mapping))


def core_ratios(mart: DataFrame, mapping: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Watts per effective MHz for each test, time bucket and core.

    Power and clock come from different sensors polled at different instants,
    so both are averaged over a bucket first; buckets that lack one of them, or
    in which the clock stood at zero, have no ratio and are left out.
    """
    labelled = core_readings(steady_state(mart), mapping)
    instruction_set = attribute(F.col("testing_software"), "instruction_set")

    def mean_of(metric: str) -> Column:
        return F.avg(F.when(F.col("metric") == metric, F.col("sensor_value")))

    averaged = (
        labelled.select(
            "test_id",
            F.window("polled_at", bucket)["start"].alias("bucket_start"),
            "core",
            "core_type",
            instruction_set,
            "metric",
            "sensor_value",
        )
        .groupBy("test_id", "bucket_start", "core", "core_type", "instruction_set")
        .agg(mean_of("power").alias("watts"), mean_of("clock").alias("mhz"))
    )
    return averaged.filter("watts IS NOT NULL AND mhz <> 0").withColumn("watts_per_mhz", F.col("watts") / F.col("mhz"))


def efficiency_summary(ratios: DataFrame, percentiles: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """Distribution of the ratio per core type and instruction set; percentiles are exact."""
    keys = ["core_type", "instruction_set"]
    folder = work_folder(ratios.sparkSession, "ratios")
    narrow = ratios.select(*keys, "watts_per_mhz")
    narrow.write.parquet(folder)
    narrow = ratios.sparkSession.read.schema(narrow.schema).parquet(folder)
    ratio = F.col("watts_per_mhz")
    summary = narrow.groupBy(*keys).agg(
        F.count("*").alias("buckets"), F.avg(ratio).alias("mean_ratio"), F.stddev_samp(ratio).alias("stddev_ratio")
    )
    found = exact_percentiles(narrow, keys, "watts_per_mhz", percentiles)
    named = found.groupBy(*keys).agg(
        *(F.max(F.when(F.col("share") == p, F.col("value"))).alias(f"p{round(p * 100):02d}_ratio") for p in percentiles)
    )
    same = reduce(and_, (summary[key].eqNullSafe(named[key]) for key in keys))
    return summary.join(named, same).select(*(summary[name] for name in summary.columns), *named.columns[len(keys) :])


def efficiency_comparison(ratios: DataFrame, first: str, second: str) -> DataFrame:
    """The two core types side by side, per instruction set."""
    sides = ratios.groupBy("instruction_set").pivot("core_type", [first, second]).agg(F.avg("watts_per_mhz"))
    a, b = F.col(f"`{first}`"), F.col(f"`{second}`")
    return sides.select(
        "instruction_set",
        a.alias("first_ratio"),
        b.alias("second_ratio"),
        (a - b).alias("difference"),
        (a / b).alias("quotient"),
    )


def stability(mart: DataFrame) -> DataFrame:
    """How steady each sensor stays per test after the ramp-up.

    ``drift_per_hour`` is the slope of a straight line through the readings.
    """
    value = F.col("sensor_value")
    hours = (F.unix_millis("polled_at") - F.unix_millis("tested_at")) / F.lit(3_600_000.0)
    spread = F.stddev_samp(value)
    return (
        steady_state(mart)
        .groupBy("test_id", "hardware_name", "sensor_name", "sensor_type")
        .agg(
            F.count("*").alias("readings"),
            F.avg(value).alias("mean_value"),
            spread.alias("stddev_value"),
            (spread / F.nullif(F.avg(value), F.lit(0.0))).alias("variation"),
            F.regr_slope(value, hours).alias("drift_per_hour"),
            F.min(value).alias("lowest"),
            F.max(value).alias("highest"),
        )
    )
