"""Schema inference: new fields become bronze columns."""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from rampline.contracts import RESCUED_COLUMN, landing_schema
from rampline.sources.landing import parse_payloads


def load_schema(spark: SparkSession, location: str) -> StructType:
    """Schema kept under ``location``, or the fixed landing schema."""
    try:
        newest = (
            spark.read.text(location)
            .select("value", F.col("_metadata.file_modification_time").alias("at"))
            .agg(F.max_by("value", F.struct("at", F.length("value"))))
            .first()[0]
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    return StructType.fromJson(json.loads(newest)) if newest else landing_schema()


def widened(known: DataType, found: DataType) -> DataType:
    """``known`` with the fields that only ``found`` has, at every level. What is known keeps its type."""
    if isinstance(known, StructType) and isinstance(found, StructType):
        seen = {field.name: field.dataType for field in found}
        kept = [
            StructField(field.name, widened(field.dataType, seen.get(field.name, field.dataType))) for field in known
        ]
        return StructType([*kept, *(field for field in found if field.name not in set(known.fieldNames()))])
    if isinstance(known, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(widened(known.elementType, found.elementType))
    return known


def _declared(variant_schema: str | None) -> DataType | None:
    """The type that describes a variant: numbers with a point as doubles, what has no one type as text."""
    if variant_schema is None:
        return None
    declared = re.sub(r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE", variant_schema.replace("OBJECT<", "STRUCT<"))
    return DataType.fromDDL(re.sub(r"\b(VOID|VARIANT)\b", "STRING", declared))


def _fields_of(parsed: DataFrame) -> DataFrame:
    """The schema that the rescued lines have in common, without a filter: it would be pushed
    below the parser and parse every line once more.
    """
    rescued = parsed.select(F.from_json(RESCUED_COLUMN, "mistyped boolean, line string").alias("kept"))
    # a line of the wrong shape would turn the type of its field, and of all below it, into text
    line = F.when(F.col("kept.mistyped").isNull(), F.col("kept.line"))
    return rescued.agg(F.schema_of_variant_agg(F.try_parse_json(line)).alias("found"))


def infer_landing_schema(spark: SparkSession, path: str, location: str, since: str | None = None) -> StructType:
    """Widen the kept schema by the fields found in the landing files.

    Only lines with keys that the kept schema does not know are looked at. Fields are added at the top, in ``metadata`` and in the readings. Hinted
    fields keep the type they have in the contract: the reading value stays text
    and the testing software stays a variant, whatever the files suggest. A field
    seen before keeps its type.

    All landing files are read, or those modified after ``since`` (a timestamp in
    the session's zone), which is what a scheduled run wants.
    """
    known = load_schema(spark, location)
    reader = spark.read if since is None else spark.read.option("modifiedAfter", since)
    parsed = parse_payloads(reader.schema("value string, ingest_date date").text(path), known)
    found = _declared(_fields_of(parsed).first()["found"])
    if not isinstance(found, StructType):
        return known
    wider = widened(known, found)
    if wider == known:
        return known
    spark.createDataFrame([(wider.json(),)], "value string").coalesce(1).write.mode("append").text(location)
    return wider


def add_new_columns(
    spark: SparkSession, table: str, schema: StructType, fmt: str = "parquet"
) -> list[str]:
    """Add the fields of ``schema`` that ``table`` lacks, at every level. Old rows read null.

    Managed and external tables alike change in one step of the catalog, so there is no
    moment without the table or with fewer fields. A Delta table takes new columns here, and
    fields inside structs when it is written.
    """
    if not spark.catalog.tableExists(table):
        return []
    present = spark.table(table).schema
    added = [field for field in schema if field.name not in set(present.fieldNames())]
    if fmt == "delta":
        if added:
            columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in added)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    elif widened(present, schema) != widened(present, present):
        _set_fields(spark, table, widened(present, schema))
    return [field.name for field in added]


def _set_fields(spark: SparkSession, table: str, schema: StructType) -> None:
    """The catalog's change behind ``ALTER TABLE ADD COLUMNS``, whose SQL has no words for fields of structs."""
    parts = {column.name for column in spark.catalog.listColumns(table) if column.isPartition}
    data = StructType([field for field in schema if field.name not in parts])
    state = spark._jsparkSession.sessionState()
    fields = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(data.json())
    parts = state.sqlParser().parseMultipartIdentifier(table)  # of the session's catalog, which goes without saying
    named = ".".join(f"`{parts.apply(at)}`" for at in range(max(0, parts.size() - 2), parts.size()))
    state.catalog().alterTableDataSchema(state.sqlParser().parseTableIdentifier(named), fields)
    spark.catalog.refreshTable(table)
