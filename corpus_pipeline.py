"""From raw documents to packed sequences: each stage is one operator over what its predecessor kept."""

from __future__ import annotations

import public_tokenizers
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from rampline.llm import lines, mixing, packing, quality, simhash
from rampline.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.kept_only(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds."""
    shorter = lines.deduplicated(docs)
    return shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by op6's fingerprints and distance."""
    return simhash.kept_only(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share of the mix takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their token ids."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("pack", pack),
]

# Tokenizing is beyond SQL; the stages are tested against brute force one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
