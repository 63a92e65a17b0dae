import hashlib
import zlib

import pyspark.sql.functions as F
import pytest

from rampline.llm import sharding

SCHEMA = "doc_id long, text string"


def jump(key, shards):
    """The published loop."""
    shard, following = -1, 0
    while following < shards:
        shard = following
        key = (key * 2862933555777941757 + 1) % 2**64
        following = int((shard + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return shard


def hashed(key):
    return int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:16], 16)


ROWS = [(i, f"text {i} é") for i in range(700)] + [(None, None), (None, "x"), (None, "x"), (5, "text 5 é"), (-3, ""), (2**62, "y" * 99_999)]


def test_assigned(spark):
    got = sharding.assigned(spark.createDataFrame(ROWS, SCHEMA), 8)
    assert set(got.columns) >= {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    rows = got.select("doc_id", "size", "text_crc32", "shard", "grown_shard").collect()
    want = [
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump(hashed(d), 8), jump(hashed(d), 9))
        for d, t in ROWS
    ]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    for shard in range(8):
        slots = sorted(r.slot for r in got.where(F.col("shard") == shard).collect())
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("shards", [1, 2, 100, 5000, 2**31 - 1])
def test_jump_hash(spark, shards):
    keys = spark.range(300).select(F.col("id").alias("key"), sharding.jump_hash(sharding.key_hash(F.col("id")), shards).alias("s"))
    assert {r.key: r.s for r in keys.collect()} == {k: jump(hashed(k), shards) for k in range(300)}


def test_a_further_shard_takes_its_part_only(spark):
    frame = spark.range(5000)
    for n in (3, 8):
        frame = frame.withColumn(f"s{n}", sharding.jump_hash(sharding.key_hash(F.col("id")), n))
        frame = frame.withColumn(f"t{n}", sharding.jump_hash(sharding.key_hash(F.col("id")), n + 1))
        moved = frame.where(F.col(f"s{n}") != F.col(f"t{n}"))
        assert moved.where(F.col(f"t{n}") != n).count() == 0
        assert 0.8 * 5000 / (n + 1) < moved.count() < 1.2 * 5000 / (n + 1)


def test_sharded_keeps_columns(spark):
    docs = spark.createDataFrame([("k", 1), (None, 2)], "name string, slot int")
    got = sharding.sharded(docs, "name", 4)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("k", 1, jump(hashed("k"), 4)), (None, 2, jump(hashed(None), 4))], key=str)
    with pytest.raises(ValueError):
        sharding.sharded(got, "name", 4)
    with pytest.raises(ValueError):
        sharding.sharded(docs, "name", 0)


def test_empty_table(spark):
    assert sharding.assigned(spark.createDataFrame([], SCHEMA), 8).count() == 0
