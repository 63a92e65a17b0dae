"""Sharding by jump consistent hashing, in Spark expressions only.

The shard of a row follows from its key and the number of shards alone: no ring, no
table, no shuffle. With one shard more a row stays where it is or moves to the new shard.

Edge cases: a null key counts as the empty text, so all such rows share a shard, as rows
with equal keys must. A null or empty text has no bytes. An empty table gives an empty
result. ``sharded`` refuses to overwrite a column, ``numbered`` returns its own columns only.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from rampline.llm.common import as_text, written

# Fixed value: the multiplier of the published generator (Lamping and Veach, 2014).
MULTIPLIER = 2862933555777941757
_LOW, _HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
_MASK = 0xFFFFFFFF

# A key jumps about ln(shards) times. So many jumps have a probability below 1e-150, and are refused.
MOST_JUMPS = 200

# Rows of a shard are numbered in so many blocks of the ordering hash.
BLOCK_DIGITS = 3


def key_hash(key: Column) -> Column:
    """64 bits of a key that any engine can compute: the first half of its MD5."""
    digest = F.md5(as_text(key))
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(digest, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def _next(state: Column) -> Column:
    """state * MULTIPLIER + 1 modulo 2^64, in parts that never overflow a long."""
    low, high = state.bitwiseAND(_MASK), F.shiftrightunsigned(state, 32)
    bottom = low.bitwiseAND(0xFFFF) * _LOW
    middle = F.shiftrightunsigned(low, 16) * _LOW
    start = bottom + F.shiftleft(middle.bitwiseAND(_MASK), 16) + 1
    cross = high.bitwiseAND(0xFFFF) * _LOW + F.shiftleft((F.shiftrightunsigned(high, 16) * _LOW).bitwiseAND(0xFFFF), 16)
    upper = (
        F.shiftrightunsigned(start, 32)
        + F.shiftleft(F.shiftrightunsigned(middle, 32), 16)
        + (low * _HIGH).bitwiseAND(_MASK)
        + cross
    )
    return F.shiftleft(upper.bitwiseAND(_MASK), 32).bitwiseOR(start.bitwiseAND(_MASK))


def jump_hash(hashed: Column, shards: int) -> Column:
    """The shard, from 0, of a 64-bit hash among ``shards``."""
    if not 0 < shards < 2**31:
        raise ValueError("the number of shards must lie between 1 and 2^31 - 1")

    def jump(state: Column, _: Column) -> Column:
        following = _next(state["key"])
        drawn = (F.shiftrightunsigned(following, 33) + 1).cast("double")
        landed = F.floor((state["next"] + 1).cast("double") * (F.lit(float(2**31)) / drawn)).cast("long")
        return F.when(
            state["next"] < shards,
            F.struct(following.alias("key"), state["next"].alias("shard"), landed.alias("next")),
        ).otherwise(state)

    begin = F.struct(hashed.alias("key"), F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(min(shards, MOST_JUMPS))),
        begin,
        jump,
        lambda s: F.when(s["next"] >= shards, s["shard"].cast("int")).otherwise(
            F.raise_error(F.lit("a key made too many jumps")).cast("int")
        ),
    )


def sharded(docs: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row's key in a new column; no shuffle."""
    if name in docs.columns:
        raise ValueError(f"the table has a column {name} already")
    return docs.withColumn(name, jump_hash(key_hash(F.col(key)), shards))


def numbered(rows: DataFrame, shard: str) -> DataFrame:
    """``rows`` with a ``slot`` that counts the rows of each shard from 0 without gaps.

    Rows are ordered by a hash of all their columns, and equal rows are counted as one before
    they are shuffled. The hash cuts each shard into blocks: a block's first slot comes from
    the counts of those before it, the others from the order within it, so no shard meets in
    one task. Meant for narrow rows with a shard each: keys and digests, not texts.
    """
    columns = rows.columns
    order = F.md5(F.concat_ws("|", *[as_text(F.col(c)) for c in columns]))
    merged = (
        rows.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_order", order)
        .withColumn("_block", F.substring("_order", 1, BLOCK_DIGITS))
    )
    in_block = Window.partitionBy(shard, "_block").orderBy("_order", *columns)
    placed = merged.withColumn("_before", F.sum("_copies").over(in_block) - F.col("_copies"))
    blocks = merged.groupBy(shard, "_block").agg(F.sum("_copies").alias("_rows"))
    by_block = Window.partitionBy(shard).orderBy("_block")
    starts = blocks.select(shard, "_block", (F.sum("_rows").over(by_block) - F.col("_rows")).alias("_start"))
    first = F.col("_start") + F.col("_before")
    return placed.join(starts, [shard, "_block"]).select(
        *columns, F.explode(F.sequence(first, first + F.col("_copies") - 1)).alias("slot")
    )


def assigned(docs: DataFrame, shards: int) -> DataFrame:
    """Per document its size, checksum, shard, slot there, and its shard if there were one more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = key_hash(F.col("doc_id"))
    digests = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        jump_hash(hashed, shards).alias("shard"),
        jump_hash(hashed, shards + 1).alias("grown_shard"),
    )
    return numbered(written(digests, "shards"), "shard").withColumn("law", F.lit("key"))
