"""Gold: readings of one device with the thermal ramp-up marked."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from rampline import contracts
from rampline.functions.variants import device_of
from rampline.operators import clustering
from rampline.operators.joins import BROADCAST_BYTES, HOT_SHARE, fact_join, fits_broadcast, slices_of
from rampline.session import work_folder

# Fixed value: a test counts as warming up for this long after its first reading.
RAMPUP = timedelta(minutes=10)


def tests_of_device(tests: DataFrame, device: str) -> DataFrame:
    return tests.filter(device_of(F.col("testing_software")) == device)


def test_starts(fact: DataFrame) -> DataFrame:
    """First poll per test; only partial minima are shuffled."""
    return fact.groupBy("test_id").agg(F.min("polled_at").alias("started_at"))


def warming_up(polled_at: Column, started_at: Column, rampup: timedelta = RAMPUP) -> Column:
    """Strictly before the end of the ramp-up; unknown times count as past it."""
    return F.coalesce(polled_at < started_at + F.lit(rampup), F.lit(False))


def device_mart(
    fact: DataFrame,
    tests: DataFrame,
    device: str,
    rampup: timedelta = RAMPUP,
    limit: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Readings of the device's tests, joined to the tests, with the ramp-up flag.

    Two narrow passes over the fact instead of a window over whole tests: the
    first reduces two columns to one minimum per wanted test, the second joins
    that small result back. While the device's tests fit a broadcast, no fact row
    is shuffled. Beyond it the second pass shuffles, with hot tests cut in slices.
    """
    wanted = tests_of_device(tests, device).select("test_id", "tested_at", "device_id", "testing_software")
    # a clustered fact is read in the buckets of the device's tests only
    readings = clustering.pruned(fact, wanted).select(*(name for name in contracts.MART_COLUMNS if name in contracts.FACT_COLUMNS))
    small = fits_broadcast(wanted, limit)
    times = readings.select("test_id", "polled_at")
    ids = wanted.select("test_id")
    if small:
        starts, hot = test_starts(times.join(F.broadcast(ids), "test_id", "left_semi")), None
    else:
        # one pass for the minima, the rows per test and their total
        counted = times.join(ids, "test_id", "left_semi").groupBy("test_id")
        counted = counted.agg(F.min("polled_at").alias("started_at"), F.count("*").alias("_rows"))
        folder = work_folder(fact.sparkSession, "starts")
        counted.write.parquet(folder)
        counted = fact.sparkSession.read.schema(counted.schema).parquet(folder)
        total = counted.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
        starts, hot = counted.drop("_rows"), slices_of(counted, ["test_id"], total * hot_share)
    described = wanted.join(starts, "test_id")
    mart = fact_join(readings, described, "test_id", small, hot)
    flag = warming_up(F.col("polled_at"), F.col("started_at"), rampup).alias("thermal_rampup_phase")
    return mart.select(*contracts.MART_COLUMNS[:-1], flag)
