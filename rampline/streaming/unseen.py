"""Appending only rows whose key a table lacks: deduplication across runs without state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rampline.operators import clustering
from rampline.session import remove_folder, work_folder


def append_unseen(
    df: DataFrame,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    path: str | None = None,
    fmt: str = "parquet",
    by_test: bool = False,
) -> StreamingQuery:
    """Start a query that appends the rows available now whose ``keys`` are new to ``table``, then stops.

    The table itself is the memory, so nothing grows beside it. A batch that was written but
    not committed is taken again after a crash, and finds its rows in the table; if only some
    of its files became visible, it adds the rest. ``by_test`` lays the table out by
    :mod:`rampline.operators.clustering`, and a batch looks only into the buckets of its tests.
    """

    def merge(batch: DataFrame, _: int) -> None:
        # in the caller's session, which else would go on listing the table's old files
        add_unseen(batch, table, keys, path, fmt, by_test, df.sparkSession)

    writer = df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def add_unseen(
    rows: DataFrame,
    table: str,
    keys: Sequence[str],
    path: str | None = None,
    fmt: str = "parquet",
    by_test: bool = False,
    session: SparkSession | None = None,
) -> int:
    """Append the ``rows`` whose ``keys`` are new to ``table``, one for each key, and return their number."""
    spark = session or rows.sparkSession
    keys = list(keys)
    rows = clustering.with_bucket(rows) if by_test else rows
    folder = work_folder(spark, "unseen")
    try:
        # a row of its own for each key, written once: what follows reads it several times
        rows.dropDuplicates(keys).write.parquet(folder)
        fresh = spark.read.schema(rows.schema).parquet(folder)
        known = _known(spark, table, fresh, keys, by_test)
        if known is not None:
            same = reduce(and_, (fresh[key].eqNullSafe(known[f"_of_{key}"]) for key in keys))
            fresh = fresh.join(known, same, "left_anti")
        n_rows = fresh.count()
        if n_rows or known is None:
            ordered = clustering.clustered(fresh, n_rows) if by_test else fresh
            writer = ordered.write.format(fmt).mode("append")
            writer = writer.partitionBy(clustering.BUCKET) if by_test else writer
            (writer if path is None else writer.option("path", path)).saveAsTable(table)
        return n_rows
    finally:
        remove_folder(spark, folder)


def _known(spark: SparkSession, table: str, fresh: DataFrame, keys: list[str], by_test: bool) -> DataFrame | None:
    """The keys that ``table`` holds where ``fresh`` could meet them; None without a table."""
    if not spark.catalog.tableExists(table):
        return None
    spark.catalog.refreshTable(table)
    held = spark.table(table)
    if by_test:
        held = clustering.pruned(held, fresh)
        # Parquet skips row groups by the least and largest time
        first, last = fresh.agg(F.min("polled_at"), F.max("polled_at")).first()
        held = held.filter(F.col("polled_at").between(F.lit(first), F.lit(last)))
    return held.select(*(F.col(key).alias(f"_of_{key}") for key in keys))
