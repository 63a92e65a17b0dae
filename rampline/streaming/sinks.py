"""Restartable append streams and whole-table replacement."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from contextlib import suppress

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

_POLL_SECONDS = 0.2
# A query that is stopped while it writes its very first offsets leaves a checkpoint that no
# later run can start from, so queries get this long to be past that, or done.
_GRACE_SECONDS = 5.0


def append_stream(
    df: DataFrame,
    table: str,
    checkpoint: str,
    path: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start a query that appends everything available now to ``table``, then stops.

    The checkpoint remembers what has been read, so a rerun without new input
    changes nothing and a rerun after a failure goes on where it stopped.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if path is not None:
        writer = writer.option("path", path)
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    return writer.trigger(availableNow=True).toTable(table)


def drain(starters: Iterable[Callable[[], StreamingQuery]]) -> None:
    """Start all queries, wait for all of them.

    They run side by side, which lets the scheduler fill the cluster while one
    query is in its narrow phase. If one cannot start or fails, the others are
    stopped and the first failure is raised; each resumes from its own
    checkpoint at the next run.
    """
    started: list[StreamingQuery] = []
    try:
        for start in starters:
            started.append(start())
        waiting = list(started)
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(_POLL_SECONDS)]
    except BaseException:
        deadline = time.monotonic() + _GRACE_SECONDS
        for query in started:
            with suppress(Exception):
                query.awaitTermination(max(0.1, deadline - time.monotonic()))
        for query in started:
            with suppress(Exception):  # the others have to stop, and the first failure is the one to tell
                query.stop()
        raise


def replace_table(df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet") -> None:
    """Rebuild ``table`` from ``df``.

    With a ``path`` the new rows are written completely into whichever of two
    directories the table does not point to, and the table is then pointed
    there: readers never see a half-written table, a failed rebuild leaves the
    old one, and storage is bounded by two versions. Without one, ``table`` is a
    view of a managed table that is written completely beforehand; Delta replaces
    its tables in one commit by itself.
    """
    spark = df.sparkSession
    if path is None and fmt == "delta":
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)
        return
    if path is None:
        _replace_managed(df, table, fmt)
        return

    exists = spark.catalog.tableExists(table)
    slots = [f"{path}/slot_a", f"{path}/slot_b"]
    target = slots[0]
    if exists and _location(df, table).endswith("/slot_a"):
        target = slots[1]
    df.write.format(fmt).mode("overwrite").save(target)
    if exists and spark.table(table).schema == spark.read.format(fmt).load(target).schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
        spark.catalog.refreshTable(table)
        return
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{target}'")


def _location(df: DataFrame, table: str) -> str:
    described = df.sparkSession.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.filter("col_name = 'Location'").first()["data_type"]


_VERSION = "rampline.version"  # the property of a view that names the table it shows


def _replace_managed(df: DataFrame, table: str, fmt: str) -> None:
    """Write a version of its own, then point the view ``table`` there in one step of the catalog.

    The version shown before is kept for readers that are still at it; older ones, and
    those that a failed rebuild left, are dropped.
    """
    spark = df.sparkSession
    schema, _, name = table.rpartition(".")
    version = f"{name}__v_{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).saveAsTable(f"{schema}.{version}" if schema else version)
    previous = None
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "VIEW":
            shown = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == _VERSION).first()
            previous = shown["value"] if shown else None
        else:  # a plain table of the time before there were versions
            spark.sql(f"DROP TABLE {table}")
    qualified = f"{schema}.{version}" if schema else version
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{_VERSION}' = '{version}') AS SELECT * FROM {qualified}")
    listed = spark.sql(f"SHOW TABLES {f'IN {schema} ' if schema else ''}LIKE '{name}__v_*'")
    for row in listed.filter(~F.col("tableName").isin(version, previous or version)).collect():
        spark.sql(f"DROP TABLE IF EXISTS {f'{schema}.' if schema else ''}{row['tableName']}")
