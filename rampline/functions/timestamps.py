"""Timestamp text used in payloads."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# How the two kinds of timestamp are spelled in a payload.
TEST_DATE_FORMAT = "yyyyMMdd_HHmmss"
POLL_FORMAT = "yyyyMMdd_HHmmssSSS"


def read_test_date(text: Column) -> Column:
    """Timestamp, or null where the text cannot be read."""
    return F.try_to_timestamp(text, F.lit(TEST_DATE_FORMAT))


def read_poll_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(POLL_FORMAT))


def write_test_date(ts: Column) -> Column:
    return F.date_format(ts, TEST_DATE_FORMAT)


def write_poll_time(ts: Column) -> Column:
    """Milliseconds are cut off, not rounded."""
    return F.date_format(ts, POLL_FORMAT)
