"""Session settings the engine relies on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Correctness: timestamps in payloads carry no zone and are read as UTC.
TIME_ZONE = ("spark.sql.session.timeZone", "UTC")

# Deduplication state outgrows the JVM heap, so it lives in RocksDB and each
# micro-batch uploads a changelog instead of a full snapshot.
STREAM_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# A struct of which a file has none of the wanted fields is null. Spark would else read some
# other field to tell whether it was there, and may pick one inside a variant, which fails.
WIDENED_STRUCTS = ("spark.sql.legacy.parquet.returnNullStructIfAllFieldsMissing", "true")

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session.

    Shuffle partitions are left to the cluster: a stateful query freezes their
    number in its checkpoint at the first run, so it has to be chosen for the
    size the state will reach, not for the first increment.
    """
    spark.conf.set(*TIME_ZONE)
    spark.conf.set(*WIDENED_STRUCTS)
    for key, value in {**STREAM_STATE, **ADAPTIVE}.items():
        spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "Sensor telemetry pipeline") -> SparkSession:
    return configure(SparkSession.builder.appName(app_name).getOrCreate())


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    Lies under the folder the cluster names in ``spark.checkpoint.dir``, else in
    the session's table storage.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/rampline-{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a work folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def bytes_per_scan_task(spark: SparkSession, most: int) -> Iterator[None]:
    """Scans planned in here, and streams started in here, give a task at most so many bytes of files."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)
