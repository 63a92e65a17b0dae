"""Line deduplication by a sharded minimal perfect hash.

The keys of lines found in several documents are spread over shards by their hash. Each
shard numbers its keys without gaps by a minimal perfect hash of cascading bit arrays, and
keeps, by that number, a fingerprint, the number of documents, and the smallest document.
Hashes of lines are dealt to the shards and probe these arrays; what comes back to the
documents are the few hashes that have to go. Texts are never joined with lines.

A key is 128 bits: one half places it, the other is the fingerprint, kept whole. Probes of
a shard are dealt over as many tasks as their number asks for, each with a copy of that
shard's arrays, so a line that a third of all documents hold burdens no single task.

Edge cases: a null or empty text is one empty line and stays what it is. Documents without
id count as one document whose id is larger than any other. Rows equal in id and text are
treated alike. Long texts are cut into lines one document at a time. An empty table gives
an empty result. ``deduplicated`` returns the input's columns; working columns carry a
prefix that no input column may have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import Column, DataFrame

from rampline.llm.common import small, written

PREFIX = "_line_"
MIN_CHARS = 10
NO_ID = 2**63 - 1
KEYS_PER_SHARD = 100_000
PROBES_PER_TASK = 1_000_000
ROOM = 2  # bits of a level per key that is left
_BLANKS = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes | None:
    """What lines are compared by; None if it is too short to be compared."""
    key = line.strip(_BLANKS).lower()  # of bytes: A-Z only
    if len(key) < MIN_CHARS or len(key) < 4 * MIN_CHARS and len(key.decode()) < MIN_CHARS:
        return None
    return key


# ---- minimal perfect hash -------------------------------------------------------------


def _mixed(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    """A new hash of the keys for each level (the finalizer of splitmix64)."""
    x = high ^ (low * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level * 0xD1342543DE82EF95 & 2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_hash(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words per level and the bits of all levels, for distinct keys.

    At each level a key that has its place to itself sets the bit there; the others go on
    to the next. A key's number is the count of bits before its own.
    """
    sizes, levels = [], []
    while len(high):
        words = (ROOM * len(high) + 63) // 64
        place = _mixed(high, low, len(sizes)) % np.uint64(64 * words)
        alone = np.bincount(place.astype(np.int64), minlength=64 * words) == 1
        levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(words)
        left = ~alone[place.astype(np.int64)]
        high, low = high[left], low[left]
    return np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, np.uint64)


class LineIndex:
    """The arrays of one shard, as built by ``build_shard``."""

    def __init__(self, row: dict) -> None:
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.bits = np.frombuffer(row["bits"], np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])
        self.fingerprints = np.frombuffer(row["fingerprints"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.owners = np.frombuffer(row["owners"], np.int64)

    def numbers(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for most keys that are not in the shard."""
        found = np.full(len(high), -1, np.int64)
        open_, start = np.arange(len(high)), 0
        for level, words in enumerate(self.sizes):
            place = _mixed(high[open_], low[open_], level) % np.uint64(64 * words)
            word, bit = (place >> np.uint64(6)).astype(np.int64) + start, place & np.uint64(63)
            here = self.bits[word]
            hit = (here >> bit) & np.uint64(1) == 1
            below = here & ((np.uint64(1) << bit) - np.uint64(1))
            found[open_[hit]] = (self.before[word] + np.bitwise_count(below))[hit]
            open_, start = open_[~hit], start + words
        return found

    def owner_of(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The smallest document of each key, NO_ID for keys that are not in the shard."""
        at = self.numbers(high, low)
        known = at >= 0
        known[known] = self.fingerprints[at[known]] == low[known]
        owners = np.full(len(high), NO_ID, np.int64)
        owners[known] = self.owners[at[known]]
        return owners


SHARD_SCHEMA = "shard int, sizes binary, bits binary, fingerprints binary, counts binary, owners binary"


def build_shard(keys: pa.Table) -> pa.Table:
    high = keys["high"].to_numpy().view(np.uint64)
    low = keys["low"].to_numpy().view(np.uint64)
    sizes, bits = build_hash(high, low)
    index = LineIndex(
        {"sizes": sizes.tobytes(), "bits": bits.tobytes(), "fingerprints": b"", "counts": b"", "owners": b""}
    )
    order = np.argsort(index.numbers(high, low))
    return pa.table(
        {
            "shard": pa.array([keys["shard"][0].as_py()], pa.int32()),
            "sizes": [sizes.tobytes()],
            "bits": [bits.tobytes()],
            "fingerprints": [low[order].tobytes()],
            "counts": [keys["n"].to_numpy().astype(np.int64)[order].tobytes()],
            "owners": [keys["owner"].to_numpy().astype(np.int64)[order].tobytes()],
        }
    )


# ---- documents to hashes and back -----------------------------------------------------


def _hashes(lines: list[bytes]) -> dict[int, tuple[int, int]]:
    """Both halves of the key of each line that is long enough, by line number."""
    found = {}
    for at, line in enumerate(lines):
        key = line_key(line)
        if key is not None:
            digest = xxhash.xxh3_128_intdigest(key)
            found[at] = (digest >> 64, digest & 2**64 - 1)
    return found


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


LINE_SCHEMA = "doc long, text_hash long, high long, low long"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, hashes, keys = [], [], []
        for doc, text_hash, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = set(_hashes(_lines(text)).values())
            keys.extend(own)
            docs.extend([doc] * len(own))
            hashes.extend([text_hash] * len(own))
        both = np.array(keys, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(hashes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1])],
            ["doc", "text_hash", "high", "low"],
        )


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard and deal, the shard's arrays first."""
    index, at = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        shard, deal = batch["shard"].to_numpy(), batch["deal"].to_numpy()
        blobs = batch["is_probe"].to_numpy(zero_copy_only=False) == 0
        cuts = [0, *(np.flatnonzero((np.diff(shard) != 0) | (np.diff(deal) != 0) | blobs[:-1] | blobs[1:]) + 1), len(shard)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if blobs[begin]:
                row = batch.slice(begin, 1).to_pylist()[0]
                index, at = LineIndex(row), (shard[begin], deal[begin])
                continue
            if at != (shard[begin], deal[begin]):  # no repeated line falls into this shard
                continue
            part = batch.slice(begin, end - begin)
            high, low = (part[c].to_numpy().view(np.uint64) for c in ("high", "low"))
            owners = index.owner_of(high, low)
            gone = pa.array((owners != NO_ID) & (owners != part["doc"].to_numpy()))
            yield part.select(["doc", "text_hash", "low"]).filter(gone)


def _identity() -> tuple[Column, Column]:
    """By what a row of documents is known: its id and the hash of its text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64(F.col("text"))


def line_index(lines: DataFrame, partitions: int) -> tuple[DataFrame, int]:
    """The arrays of all shards, and the number of shards."""
    repeated = (
        lines.groupBy("high", "low")
        .agg(F.min("doc").alias("owner"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("owner < last")
    )
    repeated = written(repeated, "line-keys")
    shards = max(partitions, -(-repeated.count() // KEYS_PER_SHARD))
    keyed = repeated.withColumn("shard", F.pmod("high", F.lit(shards)).cast("int"))
    return keyed.groupBy("shard").applyInArrow(build_shard, SHARD_SCHEMA), shards


def dropped(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, gone): the hashes of the lines that a document loses."""
    spark = docs.sparkSession
    doc, text_hash = _identity()
    lines = docs.select(doc.alias("doc"), text_hash.alias("text_hash"), "text").mapInArrow(_extract, LINE_SCHEMA)
    lines = written(lines, "lines")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index, shards = line_index(lines, partitions)
    index = written(index, "line-index")

    probes = lines.withColumn("shard", F.pmod("high", F.lit(shards)).cast("int"))
    per_task = max(1, min(PROBES_PER_TASK, lines.count() // (2 * partitions)))
    deals = probes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / per_task).cast("int").alias("deals"))
    deals = written(deals, "line-deals")
    # every probe of a key goes to a deal by its document, and each deal gets a copy of the arrays
    probes = probes.join(small(deals, shards), "shard").select(
        "shard", F.pmod(F.xxhash64("doc", "text_hash"), F.col("deals")).cast("int").alias("deal"),
        F.lit(1).alias("is_probe"), "doc", "text_hash", "high", "low",
    )
    arrays = index.join(deals, "shard").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"), F.lit(0).alias("is_probe")
    ).drop("deals")
    gone = (
        probes.unionByName(arrays, allowMissingColumns=True)
        .repartition(partitions, "shard", "deal")
        .sortWithinPartitions("shard", "deal", "is_probe")
        .mapInArrow(_probe, "doc long, text_hash long, low long")
    )
    return gone.groupBy("doc", "text_hash").agg(F.collect_set("low").alias("gone"))


def _with_drops(docs: DataFrame) -> DataFrame:
    if clash := [c for c in docs.columns if c.startswith(PREFIX)]:
        raise ValueError(f"columns {clash} carry the prefix of working columns")
    doc, text_hash = _identity()
    gone = dropped(docs).select(*[F.col(c).alias(PREFIX + c) for c in ("doc", "text_hash", "gone")])
    own = docs.withColumns({PREFIX + "own_doc": doc, PREFIX + "own_hash": text_hash})
    same = (F.col(PREFIX + "own_doc") == F.col(PREFIX + "doc")) & (F.col(PREFIX + "own_hash") == F.col(PREFIX + "text_hash"))
    return own.join(gone, same, "left").select(*docs.columns, PREFIX + "gone")


def _kept_lines(text: str | None, gone: list[int] | None) -> tuple[list[bytes], int]:
    """The lines that stay, and how many there were."""
    lines = _lines(text)
    if not gone:
        return lines, len(lines)
    out = {low & 2**64 - 1 for low in gone}
    drop = {at for at, (_, low) in _hashes(lines).items() if low in out}
    return [line for at, line in enumerate(lines) if at not in drop], len(lines)


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in zip(batch["text"].to_pylist(), batch[PREFIX + "gone"].to_pylist(), strict=True):
            texts.append(b"\n".join(_kept_lines(text, gone)[0]).decode() if gone else text)
        at = batch.schema.get_field_index("text")
        changed = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
        yield changed.drop_columns([PREFIX + "gone"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines gone from their texts that an earlier document holds."""
    return _with_drops(docs).mapInArrow(_rewrite, docs.schema)


DIGEST_SCHEMA = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            kept, before = _kept_lines(text, gone)
            rows.append((doc, before, before - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of its lines, of those dropped, and the digest of what stays."""
    return _with_drops(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(_digest, DIGEST_SCHEMA)
