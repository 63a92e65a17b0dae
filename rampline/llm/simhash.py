"""SimHash near-duplicates found by Golay-code fuzzy hashing.

The fingerprint is cut into three segments. Of two fingerprints at most two bits apart one
segment is equal, and one of the other two differs in at most one bit. So each fingerprint
gets keys of an equal segment and a fuzzy one. The fuzzy key is the index of a codeword of
the perfect binary Golay code [23,12,7]: a word within two bits of a codeword has that
codeword only; a word three bits away has also the five codewords at distance four. Any two
words one bit apart then share a codeword, whichever way their nearest ones fall.

Fingerprints are made distinct first, so exact copies are one row from then on. Within a
key all pairs are compared, but a component leaves as a star, never as all its pairs.

Edge cases: null texts and texts without words have the fingerprint zero and are linked
like any other. Texts shorter than a shingle are one shingle. Rows without id take part;
a component without any id has a null id. Long texts are hashed a million shingles at a
time. Rows equal in id and text are one document. An empty table gives an empty result.
``kept_only`` returns the input's columns; working columns carry a prefix that no input
column may have.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import DataFrame

from rampline.llm.common import written
from rampline.llm.components import components, local_roots

PREFIX = "_sim_"
SHINGLE = 3
BITS_APART = 2
SEED = 42
SHINGLES_AT_ONCE = 1_000_000

# ---- fingerprints ---------------------------------------------------------------------


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64 bits; each is one if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, SHINGLES_AT_ONCE):
        part = words[at : at + SHINGLES_AT_ONCE + width - 1]
        columns = [part[k:] for k in range(width)]
        hashed = b"".join([digest(b" ".join(shingle), SEED) for shingle in zip(*columns, strict=False)])
        ones += np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _fingerprints(width: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), width) for t in batch["text"]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(found)], ["doc_id", "text_hash", "fp"]
            )

    return hashed


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint as a signed number."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(_fingerprints(width), "doc_id long, text_hash long, fp long")


# ---- Golay code -----------------------------------------------------------------------

# Fixed value: a generator polynomial of the code, x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0b101011100011
LENGTH, CHECK_BITS = 23, 11


def _remainder(word: int) -> int:
    for shift in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> shift & 1:
            word ^= GENERATOR << (shift - CHECK_BITS)
    return word


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For words by their syndrome: the error, and the codewords five bits of which complete it.

    Also the syndromes of all 12-bit upper and 11-bit lower parts, as syndromes add up.
    """
    unit = [_remainder(1 << i) for i in range(LENGTH)]
    upper, lower = np.zeros(1 << 12, np.int64), np.zeros(1 << CHECK_BITS, np.int64)
    for i in range(CHECK_BITS):
        lower[np.arange(1 << CHECK_BITS) >> i & 1 == 1] ^= unit[i]
    for i in range(12):
        upper[np.arange(1 << 12) >> i & 1 == 1] ^= unit[CHECK_BITS + i]
    codewords = (np.arange(1 << 12) << CHECK_BITS) ^ upper
    light = codewords[np.bitwise_count(codewords) == 7]
    error, near = np.zeros(1 << CHECK_BITS, np.int64), np.zeros((1 << CHECK_BITS, 5), np.int64)
    for weight in range(1, 4):
        for bits in combinations(range(LENGTH), weight):
            pattern = sum(1 << b for b in bits)
            at = upper[pattern >> CHECK_BITS] ^ lower[pattern & (1 << CHECK_BITS) - 1]
            error[at] = pattern
            if weight == 3:
                near[at] = light[light & pattern == pattern] >> CHECK_BITS
    return upper, lower, error, near


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every codeword index of the 23-bit ``words``: one or six a word."""
    upper, lower, error, near = golay_tables()
    syndrome = upper[words >> CHECK_BITS] ^ lower[words & (1 << CHECK_BITS) - 1]
    nearest = (words ^ error[syndrome]) >> CHECK_BITS
    far = np.flatnonzero(np.bitwise_count(error[syndrome]) == 3)
    more = nearest[far, None] ^ near[syndrome[far]]
    rows = np.concatenate([np.arange(len(words)), np.repeat(far, 5)])
    return rows, np.concatenate([nearest, more.ravel()])


# Bits of the three segments, from the lowest.
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signed = batch["fp"].to_numpy()
        fp = signed.view(np.uint64)
        parts = [((fp >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
        fuzzy = [golay_keys(part) for part in parts]
        for equal in range(3):
            for near in range(3):
                if near != equal:
                    rows, index = fuzzy[near]
                    kind = 3 * equal + near
                    key = (kind << 34) | (parts[equal][rows] << 12) | index
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(signed[rows])], ["key", "fp"])


# ---- links ----------------------------------------------------------------------------

RUN_BY_SHIFTS = 64
ROWS_AT_ONCE = 1024
ALL_PAIRS_UP_TO = 100_000


def _close(a: np.ndarray, b: np.ndarray, apart: int) -> np.ndarray:
    """Whether fingerprints, words of 64 bits along the last axis, differ in few bits."""
    return np.bitwise_count(a ^ b).sum(-1) <= apart


def _pairs_of_runs(
    fp: np.ndarray, begin: np.ndarray, end: np.ndarray, apart: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked fingerprints within the runs [begin, end), in blocks."""
    size = end - begin
    run_end = np.repeat(end, size)
    place = np.concatenate([np.arange(b, e) for b, e in zip(begin, end, strict=True)]) if len(begin) else begin
    short = np.repeat(size, size) <= RUN_BY_SHIFTS
    place, run_end = place[short], run_end[short]
    for shift in range(1, RUN_BY_SHIFTS):
        inside = place + shift < run_end
        place, run_end = place[inside], run_end[inside]
        if not len(place):
            break
        hit = place[_close(fp[place], fp[place + shift], apart)]
        yield hit, hit + shift
    for b, e in zip(begin[size > RUN_BY_SHIFTS], end[size > RUN_BY_SHIFTS], strict=True):
        flips = e - b > ALL_PAIRS_UP_TO and fp.shape[1] == 1
        yield from _pairs_by_flips(fp[b:e, 0], b, apart) if flips else _pairs_of_long_run(fp[b:e], b, apart)


def _pairs_of_long_run(fp: np.ndarray, begin: int, apart: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(fp), ROWS_AT_ONCE):
        left, right = np.nonzero(_close(fp[at : at + ROWS_AT_ONCE, None], fp[None, at:], apart))
        yield left + at + begin, right + at + begin


def _pairs_by_flips(fp: np.ndarray, begin: int, apart: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For very long runs: looks up every fingerprint within reach instead of comparing all."""
    order = np.argsort(fp)
    known = fp[order]
    for n_bits in range(1, apart + 1):
        for bits in combinations(range(64), n_bits):
            flipped = fp ^ np.uint64(sum(1 << b for b in bits))
            at = np.minimum(np.searchsorted(known, flipped), len(known) - 1)
            hit = np.flatnonzero(known[at] == flipped)
            yield hit + begin, order[at[hit]] + begin


def _stars(key: np.ndarray, node: np.ndarray, fp: np.ndarray, apart: int) -> pa.RecordBatch:
    """Links between the rows of each key, as stars."""
    cuts = np.flatnonzero(np.diff(key)) + 1
    begin, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
    several = end - begin > 1
    root = np.arange(len(key))
    for left, right in _pairs_of_runs(fp, begin[several], end[several], apart):
        # block by block, so that only places are kept, not links
        touched, at = np.unique(np.concatenate([root[left], root[right]]), return_inverse=True)
        lowest = touched[local_roots(len(touched), at[: len(left)], at[len(left) :])]
        root[touched] = lowest
        root = root[root]
    moved = np.flatnonzero(root != np.arange(len(root)))
    return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], ["a", "b"])


def _links(words: tuple[str, ...], apart: int):
    """Rows come by key; a key is compared once all its rows are there."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def linked() -> pa.RecordBatch:
            return _stars(*(np.concatenate(c) for c in zip(*held, strict=True)), apart)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, node = batch["key"].to_numpy(), batch["fp"].to_numpy()
            fp = np.stack([batch[word].to_numpy().view(np.uint64) for word in words], 1)
            last = int(np.searchsorted(key, key[-1]))
            if held and key[0] == key[-1] == held[-1][0][-1]:
                held.append((key, node, fp))
                continue
            held.append((key[:last], node[:last], fp[:last]))
            yield linked()
            held = [(key[last:], node[last:], fp[last:])]
        if held:
            yield linked()

    return compare


def _by_key(keys: DataFrame, words: tuple[str, ...], apart: int) -> DataFrame:
    partitions = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_keys = keys.repartition(partitions, "key").sortWithinPartitions("key")
    return sorted_keys.mapInArrow(_links(words, apart), "a long, b long").distinct()


def links(distinct: DataFrame) -> DataFrame:
    """(a, b) between distinct fingerprints ``fp``: enough links to join all that are within reach."""
    return _by_key(distinct.select("fp").mapInArrow(_keys, "key long, fp long"), ("fp",), BITS_APART)


def groups(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written (doc_id, text_hash, fp) of all rows, and (fp, component_id, keeper) of all fingerprints.

    ``keeper`` is the document with the smallest id, and of those without id, which come last,
    the one with the smallest hash.
    """
    prints = written(prints, "sim-prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    distinct = written(prints.groupBy("fp").agg(first.alias("first")), "sim-distinct")
    linked = components(links(distinct))
    rooted = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "sim-rooted")
    least = written(rooted.groupBy("root").agg(F.min("first").alias("keeper")), "sim-least")
    found = rooted.select("fp", "root").join(least, "root").select("fp", "keeper.doc_id", "keeper")
    return prints, written(found.withColumnRenamed("doc_id", "component_id"), "sim-groups")


def components_of(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Per document its fingerprint and the smallest id it is linked to, directly or not."""
    prints, found = groups(fingerprints(docs, width))
    return prints.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


# ---- one document of each group ----------------------------------------------------------


def kept_only(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each component of linked fingerprints: its keeper."""
    if clash := [c for c in docs.columns if c.startswith(PREFIX)]:
        raise ValueError(f"columns {clash} carry the prefix of working columns")
    prints, found = groups(fingerprints(docs, width))
    keepers = found.groupBy("keeper").agg(F.min("fp").alias("fp"))
    same = prints.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    stay = keepers.select("keeper.doc_id", "keeper.text_hash").distinct()
    matches = (stay["doc_id"].eqNullSafe(same["doc_id"])) & (stay["text_hash"] == same["text_hash"])
    stay = stay.join(same, matches).select(
        stay["doc_id"].alias(PREFIX + "doc"), stay["text_hash"].alias(PREFIX + "hash"), F.col("copies").alias(PREFIX + "copies")
    )
    stay = written(stay, "sim-keepers")
    kept = docs.join(
        stay,
        F.col("doc_id").cast("long").eqNullSafe(F.col(PREFIX + "doc")) & (F.xxhash64("text") == F.col(PREFIX + "hash")),
    )
    once = kept.where(F.col(PREFIX + "copies") == 1).select(*docs.columns)
    # rows equal in id and text are one document, of which one row stays
    again = kept.where(F.col(PREFIX + "copies") > 1).dropDuplicates([PREFIX + "doc", PREFIX + "hash"])
    return once.unionByName(again.select(*docs.columns))
