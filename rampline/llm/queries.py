"""One query per operator with production parameters over its whole table, and SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rampline.llm import embeddings, lines, lm, merkle, mixing, packing, phrases, quality, runs, sharding, simhash, suffixes, token_counts
from rampline.llm.common import table


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measured(table(spark, sf_dir, "documents")).drop("broken")


def op7_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assigned(table(spark, sf_dir, "documents"), 8)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(table(spark, sf_dir, "documents"))


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary).drop("ids")


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components_of(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed(table(spark, sf_dir, "documents")).drop("begins", "ends")


def op10_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.linked(table(spark, sf_dir, "embeddings"))


def op11_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digests(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.looped(table(spark, sf_dir, "documents")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"), merkle.tampered_text())


QUERIES = {
    "op1_lm_scores": op1_lm_scores,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_curve_packing": op4_curve_packing,
    "op5_source_mix": op5_source_mix,
    "op6_simhash_groups": op6_simhash_groups,
    "op7_jump_shards": op7_jump_shards,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_embedding_groups": op10_embedding_groups,
    "op11_phrase_dedup": op11_phrase_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle_manifest": op13_merkle_manifest,
}
