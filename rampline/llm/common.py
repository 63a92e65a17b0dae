"""Tables, shared folders and text conventions of the operators."""

from __future__ import annotations

import uuid

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

# White space of all word and line rules; the same set bytes.split() and bytes.strip() use.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that the driver and every executor reach.

    Lies in the folder the cluster names in ``spark.checkpoint.dir``, else in the
    session's table storage.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def words_of(text: Column) -> Column:
    """The words of a text; none of a null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def as_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


# A broadcast relation of a few short columns stays far below 100 MB at this many rows.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ``df`` if its ``rows``, counted beforehand, are few; else leave the join to Spark."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
