"""The three stages: landing to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass
from datetime import timedelta
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from rampline import contracts
from rampline.naming import Layout, StatePaths
from rampline.operators.gold import RAMPUP, device_mart
from rampline.operators.joins import BROADCAST_BYTES
from rampline.operators.silver import clean, unkeyed
from rampline.session import bytes_per_scan_task
from rampline.sources.inference import add_new_columns, infer_landing_schema, load_schema
from rampline.sources.landing import bounded, landing_lines, to_bronze
from rampline.streaming.sinks import append_stream, drain, replace_table
from rampline.streaming.unseen import append_unseen

# Bronze files are far smaller than the readings in them, which a task of silver sorts by key:
# with Spark's 128 MB for a task they would not fit its memory.
SILVER_SCAN_BYTES = 32 << 20

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Pipeline:
    """Names of one deployment. The defaults are those of the silver and gold tables."""

    layout: Layout
    bronze_schema: str
    silver_schema: str
    gold_schema: str
    ops_schema: str
    landing_volume: str = "landing"
    ops_volume: str = "operations"
    bronze_table: str = "sensor_readings"
    fact_table: str = "fct_sensors"
    tests_table: str = "dim_hardware_tests"
    files_table: str = "dim_dbx_metadata"
    incoming_quarantine: str = "incoming_quarantine"
    outgoing_quarantine: str = "outgoing_quarantine"
    mart_table: str = "mart_device"
    fmt: str = "parquet"

    @property
    def state(self) -> StatePaths:
        return StatePaths(self.layout.volume(self.ops_schema, self.ops_volume))

    @property
    def landing_path(self) -> str:
        return self.layout.landing(self.bronze_schema, self.landing_volume)

    def bronze(self) -> str:
        return self.layout.table(self.bronze_schema, self.bronze_table)

    def silver(self, table: str) -> str:
        return self.layout.table(self.silver_schema, table)

    def quarantine(self, table: str) -> str:
        return self.layout.table(self.ops_schema, table)

    def mart(self) -> str:
        return self.layout.table(self.gold_schema, self.mart_table)


def attach(spark: SparkSession, pipeline: Pipeline, schema: str, table: str) -> str:
    """Name of a table, registered from its files where the catalog forgot it."""
    name = pipeline.layout.table(schema, table)
    path = pipeline.layout.table_path(schema, table)
    create_schema(spark, pipeline, schema)
    if path is not None and not spark.catalog.tableExists(name):
        try:
            spark.read.format(pipeline.fmt).load(path)
        except AnalysisException as unread:
            if unread.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return name  # nothing written yet
        spark.sql(f"CREATE TABLE {name} USING {pipeline.fmt} LOCATION '{path}'")
        if any(column.isPartition for column in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)
    return name


def create_schema(spark: SparkSession, pipeline: Pipeline, schema: str) -> None:
    qualified = f"{pipeline.layout.catalog}.{schema}"
    if not spark.catalog.databaseExists(qualified):
        spark.sql(f"CREATE SCHEMA {qualified}")


def _append(spark: SparkSession, pipeline: Pipeline, df: DataFrame, schema: str, table: str, state_key: str):
    attach(spark, pipeline, schema, table)
    return partial(
        append_stream,
        df,
        pipeline.layout.table(schema, table),
        pipeline.state.checkpoint(state_key),
        pipeline.layout.table_path(schema, table),
        pipeline.fmt,
    )


def run_bronze(
    spark: SparkSession,
    pipeline: Pipeline,
    run_id: str,
    infer_schema: bool = True,
    infer_since: str | None = None,
    max_bytes: str | None = None,
    max_files: int | None = None,
    archive: str | None = None,
) -> None:
    """Append the payloads that landed since the last run.

    New fields widen the table, managed or external. Files that are done with move
    to ``archive``, if given; those of the last micro-batch move when later files are read.
    """
    table = attach(spark, pipeline, pipeline.bronze_schema, pipeline.bronze_table)
    location = pipeline.state.schema(pipeline.bronze_table)
    if infer_schema:
        schema = infer_landing_schema(spark, pipeline.landing_path, location, infer_since)
    else:
        schema = load_schema(spark, location)
    add_new_columns(spark, table, schema, pipeline.fmt)
    lines = landing_lines(spark, pipeline.landing_path, max_bytes=max_bytes, max_files=max_files, archive=archive)
    rows = to_bronze(lines, run_id, schema)
    drain([_append(spark, pipeline, rows, pipeline.bronze_schema, pipeline.bronze_table, pipeline.bronze_table)])
    logger.info("ingested new landing files into %s, run %s", table, run_id)


def run_silver(
    spark: SparkSession,
    pipeline: Pipeline,
    max_bytes: str | None = None,
    max_files: int | None = None,
    strict_numbers: bool = False,
) -> None:
    """Validate the new bronze rows into the silver and quarantine tables.

    Facts and dimensions take the rows whose key their table lacks.
    """
    source = attach(spark, pipeline, pipeline.bronze_schema, pipeline.bronze_table)
    reader = bounded(spark.readStream, max_bytes, max_files)
    cleaned = clean(reader.table(source), str(uuid.uuid4()), strict_numbers)
    tables = unkeyed(cleaned)

    starters = []
    for df, table in (
        (cleaned.incoming_quarantine, pipeline.incoming_quarantine),
        (cleaned.outgoing_quarantine, pipeline.outgoing_quarantine),
    ):
        add_new_columns(spark, attach(spark, pipeline, pipeline.ops_schema, table), df.schema, pipeline.fmt)
        # quarantine state is keyed by the full table name, silver state by the bare one
        starters.append(_append(spark, pipeline, df, pipeline.ops_schema, table, pipeline.quarantine(table)))
    for df, table, key in (
        (tables.fact, pipeline.fact_table, contracts.FACT_KEY),
        (tables.tests, pipeline.tests_table, contracts.TESTS_KEY),
        (tables.files, pipeline.files_table, contracts.FILES_KEY),
    ):
        name, path = attach(spark, pipeline, pipeline.silver_schema, table), pipeline.layout.table_path(pipeline.silver_schema, table)
        by_test = table == pipeline.fact_table
        starters.append(partial(append_unseen, df, name, pipeline.state.checkpoint(table), key, path, pipeline.fmt, by_test))
    with bytes_per_scan_task(spark, SILVER_SCAN_BYTES):
        drain(starters)
    logger.info("validated new rows of %s", source)


def run_gold(
    spark: SparkSession,
    pipeline: Pipeline,
    device: str,
    rampup: timedelta = RAMPUP,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """Rebuild the mart of one device."""
    fact = spark.table(attach(spark, pipeline, pipeline.silver_schema, pipeline.fact_table))
    tests = spark.table(attach(spark, pipeline, pipeline.silver_schema, pipeline.tests_table))
    create_schema(spark, pipeline, pipeline.gold_schema)
    path = pipeline.layout.table_path(pipeline.gold_schema, pipeline.mart_table)
    replace_table(device_mart(fact, tests, device, rampup, broadcast_bytes), pipeline.mart(), path, pipeline.fmt)
    logger.info("rebuilt %s for device %s", pipeline.mart(), device)
