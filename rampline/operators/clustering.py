"""The fact's layout: partitions by a hash of the test, files sorted by test and time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BUCKET = "test_bucket"
# Fixed by the first write: tables keep the buckets their rows were written to.
BUCKETS = 64
ROWS_PER_FILE = 2_000_000


def bucket_of(test_id: Column) -> Column:
    return F.pmod(F.xxhash64(test_id), F.lit(BUCKETS)).cast("int")


def with_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn(BUCKET, bucket_of(F.col("test_id")))


def touched(df: DataFrame) -> list[int]:
    """The buckets that the tests of ``df`` fall in: so many numbers at most as there are buckets."""
    return sorted(row[0] for row in df.select(bucket_of(F.col("test_id"))).distinct().collect())


def pruned(fact: DataFrame, tests: DataFrame) -> DataFrame:
    """``fact`` without the partitions that hold none of the ``tests``, where it is laid out so.

    The buckets are looked up first, so that no scan even lists the files of the others.
    """
    if BUCKET not in fact.columns:
        return fact
    return fact.filter(F.col(BUCKET).isin(touched(tests)))


def clustered(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of so many ``rows``, in one file for each bucket and share of the rows.

    Dealt by range, so a test with most of the rows is cut by time, and a file's least and
    largest test and time tell a scan whether to read it.
    """
    order = (BUCKET, "test_id", "polled_at")
    return df.repartitionByRange(max(1, -(-rows // ROWS_PER_FILE)), *order).sortWithinPartitions(*order)
