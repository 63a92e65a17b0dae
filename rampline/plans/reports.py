"""Reports over the quarantine and the lineage of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rampline.operators.joins import fact_join, fits_broadcast


def reason_report(quarantine: DataFrame) -> DataFrame:
    """How many quarantined rows each reason was given for."""
    return (
        quarantine.select(F.explode("quarantine").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("rows"))
    )


def with_lineage(fact: DataFrame, files: DataFrame) -> DataFrame:
    """Readings with the upload date, run and ingestion time of their file."""
    return fact_join(fact, files, "source_file", fits_broadcast(files))
