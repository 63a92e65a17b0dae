"""Exact percentiles without gathering or sorting a group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from rampline.operators.joins import fits_broadcast
from rampline.session import work_folder

DIGIT = 16  # bits that one round settles
ROUNDS = 64 // DIGIT

_FRACTION = 2.0**52
_LEAST_NORMAL = 2.0**-1022


def sortable_bits(value: Column) -> Column:
    """A double's bits as a whole number that sorts as the double does.

    Built from its exponent and fraction by exact arithmetic, as SQL cannot look at bits:
    scaling by powers of two rounds nothing. Both zeros are 0, not-a-number is the largest.
    """
    size = F.abs(value)
    guess = F.least(F.lit(1023.0), F.greatest(F.lit(-1022.0), F.floor(F.log2(size))))
    low = F.pow(F.lit(2.0), guess)
    # the logarithm may round across a power of two
    exponent = guess + F.when(size < low, -1).when(size / 2.0 >= low, 1).otherwise(0)
    fraction = size / F.pow(F.lit(2.0), exponent) - 1.0
    normal = (exponent.cast("bigint") + 1023) * int(_FRACTION) + (fraction * _FRACTION).cast("bigint")
    bits = (
        F.when(F.isnan(value), F.lit(2047 * int(_FRACTION) + 1))
        .when(size == float("inf"), F.lit(2047 * int(_FRACTION)))
        .when(size < _LEAST_NORMAL, (size * 2.0**537 * 2.0**537).cast("bigint"))
        .otherwise(normal)
    )
    return F.when(value < 0, -bits).otherwise(bits)


def _kept(df: DataFrame) -> DataFrame:
    folder = work_folder(df.sparkSession, "percentiles")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """(keys, share, value): per group the smallest value that at least that share of its values reach.

    A radix search: each of four rounds counts the values by the next 16 bits, from the
    highest, among those that agree with a wanted one in the bits before, and so settles
    these bits, whatever the values are. Only counts are shuffled, combined beforehand, and a
    window sees at most 65,536 of them for each wanted value. Null values do not count;
    infinite ones do, and not-a-number counts as larger than all.
    """
    keys = list(keys)
    number = F.col(value).cast("double")
    values = df.select(*keys, number.alias("_value"), sortable_bits(number).alias("_bits")).filter("_value IS NOT NULL")

    def same(others: DataFrame, *prefix: str) -> Column:
        pairs = [F.col(name).eqNullSafe(others[f"_of_{name}"]) for name in (*keys, *prefix)]
        return reduce(and_, pairs, F.lit(True))

    def renamed(frame: DataFrame, *prefix: str) -> DataFrame:
        return frame.withColumnsRenamed({name: f"_of_{name}" for name in (*keys, *prefix)})

    def counted(frame: DataFrame, *prefix: str, shift: int) -> DataFrame:
        """Counts by the next digit, with how many values of the same group and prefix stand before it."""
        counts = frame.groupBy(*keys, *prefix, F.shiftright("_bits", shift).alias("_next")).agg(
            F.count("*").alias("_rows"), F.min("_value").alias("_least")
        )
        along = Window.partitionBy(*keys, *prefix)
        running = F.sum("_rows").over(along.orderBy("_next"))
        return counts.withColumns({"_before": running - F.col("_rows"), "_all": F.sum("_rows").over(along)})

    holds = (F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_before") + F.col("_rows"))
    settled = [F.col("_next").alias("_prefix"), (F.col("_rank") - F.col("_before")).alias("_rank"), "_least"]

    every = F.explode(F.array(*map(F.lit, map(float, shares)))).alias("share")
    first = counted(values, shift=64 - DIGIT).select("*", every)
    first = first.withColumn("_rank", F.greatest(F.lit(1), F.ceil(F.col("share") * F.col("_all"))).cast("bigint"))
    wanted = _kept(first.filter(holds).select(*keys, "share", *settled))
    small = fits_broadcast(wanted)  # it keeps a row for each group and share
    for shift in range(64 - 2 * DIGIT, -1, -DIGIT):
        spots = renamed(wanted.select(*keys, "_prefix").distinct(), "_prefix")
        prefixed = values.withColumn("_prefix", F.shiftright("_bits", shift + DIGIT))
        inside = prefixed.join(F.broadcast(spots) if small else spots, same(spots, "_prefix"), "left_semi")
        counts = renamed(counted(inside, "_prefix", shift=shift), "_prefix")
        found = wanted.drop("_least").join(counts, same(counts, "_prefix")).filter(holds)
        wanted = _kept(found.select(*keys, "share", *settled))
    return wanted.select(*keys, "share", F.col("_least").alias("value"))
