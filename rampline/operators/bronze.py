"""Bronze: payloads as they came, plus where they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_audit(df: DataFrame, run_id: str) -> DataFrame:
    """Source file, ingestion time and run id on every row of a file scan."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("dbx_ingest_date"),
        F.lit(run_id).alias("execution_id"),
    )


def with_upload_date(df: DataFrame) -> DataFrame:
    """Name the date of the landing directory."""
    return df.withColumnRenamed("ingest_date", "adls_upload_date")
