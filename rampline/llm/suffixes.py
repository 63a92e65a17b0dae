"""Removing long strings that occur in an earlier document, by sorted suffixes.

Sorting the suffixes of all documents in one place is out of the question, so they are
sharded by content. A string of ``LENGTH`` bytes is filed under its anchor, the 8-byte
piece in it with the smallest hash, and a segment is a run of such strings with the same
anchor. Equal strings have equal anchors, so shards by anchor never miss a pair, and most
anchors occur in one document only and end there.

Of those that remain, segments equal to one of an earlier document go as a whole. What is
left are segments with the same anchor and different surroundings, such as the ends of
shared passages. Their strings are cut into blocks by how far the anchor lies from the
string's start; all strings of a block have some 40 bytes in common, its core, and only
blocks whose core another document holds too go on, filed by the core. Of equal blocks the
earliest speaks for the others. The suffixes of different blocks with equal cores are
sorted, by induction in external memory, and runs of suffixes that share ``LENGTH`` bytes
show which strings an earlier document holds. A core with more than ``HOT`` rows is not
brought to one task: its blocks are taken apart into their strings, each filed by itself.

Within a task the earliest holder of a segment speaks for the others, so a passage that a
third of all documents share sends one row per task. Documents come together with what was
found about them by two joins; only those with sorted segments take part in the second.

Edge cases: null and empty texts have no bytes. Documents without id count as later than
any other, and as one, so they lose nothing to each other; nor do rows with equal ids.
Long texts are cut into segments one chunk of documents at a time. Removal may cut a
character; what remains is bytes. An empty table gives an empty result. Columns other than
id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import DataFrame

from rampline.llm.common import small, written
from rampline.llm.suffix_sort import sorted_suffixes

LENGTH = 50
GRAM = 8
# How far a string starts before its anchor, first and last of each block.
BLOCKS = ((0, 10), (11, 21), (22, 32), (33, LENGTH - GRAM))
NO_ID = 2**63 - 1
BYTES_AT_ONCE = 4_000_000
SEGMENTS_PER_BLOCK = 1_000_000
BYTES_PER_SHARD = 16_000_000
BYTES_PER_SORT = 4_000_000
HOT = 2_000  # rows with the same core that go to one task


class Segments(NamedTuple):
    begin: np.ndarray
    end: np.ndarray
    anchor: np.ndarray  # hash of the anchor
    doc: np.ndarray  # place of the document
    at: np.ndarray  # where the anchor stands
    cores: np.ndarray  # 16 bits of the core of each block, 0 if the segment has no string of the block


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _cores(words: np.ndarray, begin: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """16 bits of the core of each block, never 0 where strings from ``begin`` to ``last`` belong to it."""
    found = np.zeros((len(at), len(BLOCKS)), np.uint16)
    for block, (near, far) in enumerate(BLOCKS):
        own = np.flatnonzero((begin <= at - near) & (last >= at - far))
        hashes = np.zeros(len(own), np.uint64)
        for offset in [*range(-near, LENGTH - far - 8, 8), LENGTH - far - 8]:
            hashes = _scrambled(hashes ^ words[at[own] + offset])
        found[own, block] = hashes % np.uint64(65535) + np.uint64(1)
    return found


def segments(texts: list[bytes]) -> tuple[bytes, Segments]:
    """All texts end to end, and the runs of strings with the same anchor, none across texts."""
    raw = b"".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    n = len(raw) - LENGTH + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return raw, Segments(none, none, none.astype(np.uint64), none, none, np.zeros((0, len(BLOCKS)), np.uint16))
    words = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
    least = hashes = _scrambled(words)
    at, width, most = np.arange(len(hashes), dtype=np.int32), 1, LENGTH - GRAM + 1
    while width < most:  # the leftmost smallest of the next ``width`` hashes, for growing widths
        step = min(width, most - width)
        left = least[:-step] <= least[step:]
        at = np.where(left, at[:-step], at[step:])
        least = np.where(left, least[:-step], least[step:])
        width += step
    doc = np.repeat(np.arange(len(texts)), sizes)[:n]
    inside = np.arange(n) + LENGTH <= np.cumsum(sizes)[doc]
    new = np.ones(n, bool)
    new[1:] = (at[1:n] != at[: n - 1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
    begin = np.flatnonzero(new & inside)
    stops = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))
    anchor, doc = at[begin].astype(np.int64), doc[begin]
    return raw, Segments(begin, stops + LENGTH, hashes[anchor], doc, anchor, _cores(words, begin, stops, anchor))


def _names(raw: bytes, found: Segments) -> np.ndarray:
    """64-bit hashes of the segments' bytes."""
    digest = xxhash.xxh3_64_intdigest
    pairs = zip(found.begin.tolist(), found.end.tolist(), strict=True)
    return np.fromiter((digest(raw[b:e]) for b, e in pairs), np.uint64, len(found.begin))


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for at, text in enumerate(texts):
        if size and size + len(text) > BYTES_AT_ONCE:
            yield begin, at
            begin, size = at, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _bytes_of(column: pa.Array) -> list[bytes]:
    return [(t.as_py() or "").encode() for t in column]


# ---- which segments are shared --------------------------------------------------------

BLOCK = "shard int, anchors binary, names binary, cores binary, at binary, docs binary, hashes binary"


def _blocks(shards: int):
    """Per shard the anchors and names of segments with their documents.

    Of the documents with the same segment only the earliest is sent; the later ones lose it
    whatever the others hold, which is sent as a block without anchors.
    """

    def block(shard: int, anchors, names, cores, at, docs, hashes) -> tuple:
        own, at = np.unique(at, return_inverse=True)
        at = at.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32).tobytes()
        if anchors is None:
            return shard, None, names.tobytes(), None, at, docs[own].tobytes(), hashes[own].tobytes()
        # 40 bits of an anchor do within a shard: anchors taken for equal are only compared in vain
        short = (anchors >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
        return shard, short, names.tobytes(), cores.tobytes(), at, docs[own].tobytes(), hashes[own].tobytes()

    def blocks(parts: list[tuple]) -> pa.RecordBatch:
        sizes = [len(part[-1]) for part in parts]
        anchors, names, cores, at, docs, hashes = (np.concatenate(c) for c in zip(*parts, strict=True))
        at = at + np.repeat(np.cumsum(sizes) - sizes, [len(part[0]) for part in parts])
        order = np.lexsort((at, docs[at], names, anchors))
        anchors, names, cores, at = anchors[order], names[order], cores[order], at[order]
        new = np.ones(len(order), bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (names[1:] != names[:-1])
        again = ~new
        again[1:] &= at[1:] == at[:-1]
        later = (docs[at] > docs[at[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]]) & ~again
        first = ~later & ~again
        rows = []
        if later.any():
            rows.append(block(int(names[0] % np.uint64(shards)), None, names[later], None, at[later], docs, hashes))
        shard = (anchors % np.uint64(shards)).astype(np.int64)
        order = np.flatnonzero(first)[np.argsort(shard[first], kind="stable")]
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        for own in np.split(order, cuts):
            rows.append(block(int(shard[own[0]]), anchors[own], names[own], cores[own], at[own], docs, hashes))
        types = [pa.int32(), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
            ["shard", "anchors", "names", "cores", "at", "docs", "hashes"],
        )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            docs, hashes = batch["doc"].to_numpy(), batch["text_hash"].to_numpy()
            texts = _bytes_of(batch["text"])
            for begin, end in _chunks(texts):
                raw, found = segments(texts[begin:end])
                if not len(found.begin):
                    continue
                parts.append((found.anchor, _names(raw, found), found.cores, found.doc, docs[begin:end], hashes[begin:end]))
                held += len(found.begin)
                if held >= SEGMENTS_PER_BLOCK:
                    yield blocks(parts)
                    parts, held = [], 0
        if parts:
            yield blocks(parts)

    return extract


FOUND = "doc long, text_hash long, name long, verdict int"
GONE = 0  # any other verdict has one bit for each block whose core is shared


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard. Which segments of a document go, and which have to be sorted."""

    def decisions(docs, hashes, names, verdict) -> pa.RecordBatch:
        columns = (docs, hashes, names.view(np.int64), verdict.astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "text_hash", "name", "verdict"])

    def columns(row: dict) -> tuple:
        n = len(row["names"]) // 8
        at = np.frombuffer(row["at"], np.uint16 if len(row["at"]) == 2 * n else np.uint32)
        docs, hashes = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["hashes"], np.int64)
        return np.frombuffer(row["names"], np.uint64), docs[at], hashes[at]

    def shared(anchors: np.ndarray, core: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Whether segments of several owners have the anchor in this core."""
        found = np.zeros(len(anchors), bool)
        own = np.flatnonzero(core)
        if not len(own):
            return found
        both = anchors[own] << np.uint64(16) | core[own]  # the anchors have 40 bits
        order = np.argsort(both)
        starts = np.flatnonzero(np.append(True, np.diff(both[order]) != 0))
        owner = owner[own[order]]
        several = np.minimum.reduceat(owner, starts) < np.maximum.reduceat(owner, starts)
        found[own[order]] = np.repeat(several, np.diff(np.append(starts, len(order))))
        return found

    def whole(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        anchors, cores, names, docs, hashes = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((docs, names, anchors))
        anchors, cores, names, docs, hashes = anchors[order], cores[order], names[order], docs[order], hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(anchors) != 0) | (np.diff(names) != 0)
        begins = np.flatnonzero(new)
        owner = np.repeat(docs[begins], np.diff(np.append(begins, len(docs))))
        gone = docs > owner
        # blocks of other segments need sorting if one of another owner has their core
        verdict = sum(shared(anchors, cores[:, b], owner).astype(np.int32) << b for b in range(len(BLOCKS)))
        verdict[gone] = GONE
        use = gone | (verdict > 0)
        yield decisions(docs[use], hashes[use], names[use], verdict[use])

    shard, parts = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if parts and row["shard"] != shard:
                yield from whole(parts)
                parts = []
            shard = row["shard"]
            names, docs, hashes = columns(row)
            if row["anchors"] is None:
                yield decisions(docs, hashes, names, np.full(len(docs), GONE))
            else:
                short = np.zeros((len(names), 8), np.uint8)
                short[:, :5] = np.frombuffer(row["anchors"], np.uint8).reshape(-1, 5)
                cores = np.frombuffer(row["cores"], np.uint16).reshape(-1, len(BLOCKS))
                parts.append((short.view("<u8")[:, 0], cores, names, docs, hashes))
    if parts:
        yield from whole(parts)


# ---- documents ------------------------------------------------------------------------

RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, begins array<long>, ends array<long>"


def _result(text: bytes, marks: np.ndarray) -> tuple:
    """What is left of a text if the strings that start at ``marks`` go."""
    starts = np.flatnonzero(marks)
    if not len(starts):
        return len(text), 0, 0, hashlib.sha256(text).hexdigest(), [], []
    delta = np.zeros(len(text) + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + LENGTH, -1)
    covered = np.cumsum(delta[:-1]) > 0
    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
    kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
    begins, ends = edges[::2].tolist(), edges[1::2].tolist()
    return len(text), int(covered.sum()), len(begins), hashlib.sha256(kept).hexdigest(), begins, ends


def _marks(found: Segments, chosen: np.ndarray, size: int) -> np.ndarray:
    """Starts of all strings of the chosen segments of one text."""
    delta = np.zeros(size + 1, np.int64)
    np.add.at(delta, found.begin[chosen], 1)
    np.add.at(delta, found.end[chosen] - LENGTH + 1, -1)
    return np.cumsum(delta[:-1]) > 0


FIRST = (
    f"doc_id long, doc long, text_hash long, {RESULT}, raw binary, marks binary, "
    "open array<struct<core: long, places: array<long>, text: binary>>"
)
_RESULT_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
_RESULT_NAMES = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "begins", "ends")


def _chosen(names: np.ndarray, doc: np.ndarray, lists: list[list[int] | None]) -> np.ndarray:
    """Whether each segment's name is in the list of its document."""
    own = [np.array(wanted or [], np.int64).view(np.uint64) for wanted in lists]
    salt = np.uint64(0x9E3779B97F4A7C15)
    wanted = np.concatenate(own) ^ (np.repeat(np.arange(len(own)), [len(o) for o in own]).astype(np.uint64) * salt)
    return np.isin(names ^ (doc.astype(np.uint64) * salt), wanted)


LISTS = ("gone", *(f"shared_{block}" for block in range(len(BLOCKS))))


def _first_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of documents that are done, and the segments of the others that have to be sorted."""
    opened = pa.list_(pa.struct([("core", pa.int64()), ("places", pa.list_(pa.int64())), ("text", pa.binary())]))
    types = (*_RESULT_TYPES, pa.binary(), pa.binary(), opened)
    nothing = np.zeros(0, bool)

    def digest(core: bytes, seed: int) -> int:
        return xxhash.xxh3_64_intdigest(core, seed) - 2**63

    def cut(texts: list[bytes], gone: list, *shared: list) -> Iterator[tuple]:
        raw, found = segments(texts)
        names = _names(raw, found)
        marks = _marks(found, _chosen(names, found.doc, gone), len(raw))
        text_begin = np.cumsum([0, *map(len, texts)])
        by_doc: dict[int, dict[tuple[int, bytes], list[int]]] = {}
        for (near, far), lists in zip(BLOCKS, shared, strict=True):
            own = np.flatnonzero(_chosen(names, found.doc, lists) & (found.begin <= found.at - near) & (found.end - LENGTH >= found.at - far))
            low = np.maximum(found.begin[own], found.at[own] - far)
            high = np.minimum(found.end[own], found.at[own] - near + LENGTH)
            place = low - text_begin[found.doc[own]]
            columns = (found.doc[own], found.at[own], low, high, place)
            for doc, at, begin, end, where in zip(*(c.tolist() for c in columns), strict=True):
                core = digest(raw[at - near : at - far + LENGTH], near)
                parts = by_doc.setdefault(doc, {})
                parts.setdefault((core, raw[begin:end]), []).append(where)
        for at, text in enumerate(texts):
            own = marks[text_begin[at] : text_begin[at + 1]]
            if at not in by_doc:
                yield (*_result(text, own), None, None, None)
                continue
            parts = [{"core": core, "places": places, "text": part} for (core, part), places in by_doc[at].items()]
            yield (*[None] * 6, text, np.packbits(own).tobytes(), parts)

    for batch in batches:
        lists, texts = [batch[c].to_pylist() for c in LISTS], _bytes_of(batch["text"])
        touched = [at for at in range(len(texts)) if any(names[at] for names in lists)]
        rows: list = [None] * len(texts)
        for begin, end in _chunks([texts[at] for at in touched]):
            part = touched[begin:end]
            cuts = cut([texts[at] for at in part], *([names[at] for at in part] for names in lists))
            for at, row in zip(part, cuts, strict=True):
                rows[at] = row
        for at, row in enumerate(rows):
            if row is None:
                rows[at] = (*_result(texts[at], nothing), None, None, None)
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 9, types, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["doc"], batch["text_hash"], *arrays],
            ["doc_id", "doc", "text_hash", *_RESULT_NAMES, "raw", "marks", "open"],
        )


# ---- sorting --------------------------------------------------------------------------


def repeated_starts(texts: list[bytes], docs: np.ndarray) -> list[tuple[int, int]]:
    """(text, start) of the strings that a text with a smaller document holds too."""
    if not texts:
        return []
    raw = b"".join(text + b"\0" for text in texts)
    ends = np.cumsum([len(text) + 1 for text in texts]) - 1
    symbols = np.frombuffer(raw, np.uint8).astype(np.int16) + 2
    symbols[ends] = 1
    symbols = np.append(symbols, np.int16(0))
    padded = raw + bytes(8)
    words = np.ndarray((len(raw),), "<u8", padded, 0, (1,))
    offsets = [*range(0, LENGTH - 8, 8), LENGTH - 8]
    owner = np.repeat(np.arange(len(texts)), [len(text) + 1 for text in texts])
    found: list[tuple[int, int]] = []
    run = np.zeros(0, np.int64)  # suffixes so far that share the string of the last one

    def close(places: np.ndarray, same: np.ndarray) -> None:
        """Judges the runs in ``places``, where ``same`` tells whether each shares the string of the one before."""
        begins = np.flatnonzero(~same)
        least = np.minimum.reduceat(docs[owner[places]], begins)
        late = places[docs[owner[places]] > np.repeat(least, np.diff(np.append(begins, len(places))))]
        text = owner[late]
        starts = np.concatenate([[0], ends[:-1] + 1])
        found.extend(zip(text.tolist(), (late - starts[text]).tolist(), strict=True))

    for block in sorted_suffixes(symbols):
        block = block[block < len(raw)]
        block = block[ends[owner[block]] - block >= LENGTH]
        if not len(block):
            continue
        places = np.concatenate([run, block])
        same = np.zeros(len(places), bool)
        same[1:] = np.logical_and.reduce([words[places[1:] + k] == words[places[:-1] + k] for k in offsets])
        last = np.flatnonzero(~same)[-1]
        if last:
            close(places[:last], same[:last])
        run = places[last:]
    if len(run):
        same = np.ones(len(run), bool)
        same[0] = False
        close(run, same)
    return found


SORTED = "doc long, text_hash long, starts array<long>"


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the same cores: where strings start, in their documents, that an earlier document holds."""
    table = pa.Table.from_batches(list(batches), pa.schema([
        ("core", pa.int64()), ("places", pa.list_(pa.int64())), ("text", pa.binary()), ("doc", pa.int64()), ("text_hash", pa.int64())]))
    if not table.num_rows:
        return
    coded = table["text"].combine_chunks().dictionary_encode()
    code, texts, docs = coded.indices.to_numpy(), coded.dictionary.to_pylist(), table["doc"].to_numpy()
    first = np.full(len(texts), NO_ID)
    np.minimum.at(first, code, docs)
    core = np.zeros(len(texts), np.int64)
    core[code] = table["core"].to_numpy()
    # a text without another one of its core has nothing to be compared with
    _, group, n = np.unique(core, return_inverse=True, return_counts=True)
    compared = np.flatnonzero(n[group] > 1)
    by_text: dict[int, list[int]] = {}
    for k, start in repeated_starts([texts[k] for k in compared], first[compared]):
        by_text.setdefault(int(compared[k]), []).append(start)
    late = docs > first[code]  # all strings of these stand in an equal text
    use = np.flatnonzero(late | np.isin(code, np.array(list(by_text), np.int64)))
    if not len(use):
        return
    rows = table.take(pa.array(use)).combine_chunks()
    starts = []
    for k, own, places in zip(code[use].tolist(), late[use].tolist(), rows["places"].to_pylist(), strict=True):
        inside = range(len(texts[k]) - LENGTH + 1) if own else by_text[k]
        starts.append([place + start for place in places for start in inside])
    chosen = rows.select(["doc", "text_hash"])
    yield from chosen.append_column("starts", pa.array(starts, pa.list_(pa.int64()))).to_batches()


def _sorted_starts(rows: DataFrame, sorters: int) -> DataFrame:
    """Starts of repeated strings in blocks whose cores have few rows."""
    rows = rows.repartition(sorters, "core").select("core", "places", "text", "doc", "text_hash")
    return rows.mapInArrow(_sort, SORTED)


def _hot_starts(rows: DataFrame) -> DataFrame:
    """The same for blocks whose cores have many rows, string by string.

    The earliest holder of a string is found by an aggregation that combines before its shuffle;
    strings with many rows are few, as each takes ``HOT`` of them, and are joined without a shuffle.
    """
    skip = F.explode(F.sequence(F.lit(0), F.octet_length("text") - LENGTH))
    strings = rows.select("doc", "text_hash", "places", "text", skip.alias("skip")).select(
        "doc", "text_hash", "places", "skip", F.substring("text", F.col("skip") + 1, F.lit(LENGTH)).alias("string")
    )
    firsts = strings.groupBy("string").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
    firsts = written(firsts.where("first < last").select(F.col("string").alias("held"), "first", "n"), "suffix-strings")
    common, rare = firsts.where(F.col("n") > HOT).drop("n"), firsts.where(F.col("n") <= HOT).drop("n")
    common = small(common, common.count())
    same = F.col("string") == F.col("held")
    late = strings.join(common, same).unionByName(strings.join(common, same, "left_anti").join(rare, same))
    late = late.where(F.col("doc") > F.col("first"))
    return late.select("doc", "text_hash", F.transform("places", lambda place: place + F.col("skip")).alias("starts"))


FINAL = f"doc_id long, {RESULT}"


def _second_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = (batch[c].to_pylist() for c in ("raw", "marks", "found"))
        for text, packed, more in zip(*columns, strict=True):
            marks = np.unpackbits(np.frombuffer(packed, np.uint8), count=len(text)).astype(bool)
            if more:
                marks[more] = True
            rows.append(_result(text, marks))
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, _RESULT_TYPES, strict=True)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], ["doc_id", *_RESULT_NAMES])


def removed(docs: DataFrame) -> DataFrame:
    """Per document its bytes, those removed and in how many spans, where these lie, and the digest of the rest."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(partitions, n_bytes // BYTES_PER_SHARD)
    blocks = rows.select("doc", "text_hash", "text").mapInArrow(_blocks(shards), BLOCK)
    found = blocks.repartition(partitions, "shard").sortWithinPartitions("shard").mapInArrow(_judge, FOUND)
    which = [F.col("verdict") == GONE, *(F.col("verdict").bitwiseAND(1 << block) > 0 for block in range(len(BLOCKS)))]
    lists = [F.collect_list(F.when(own, F.col("name"))).alias(name) for name, own in zip(LISTS, which, strict=True)]
    found = found.groupBy("doc", "text_hash").agg(*lists)
    found = found.withColumnsRenamed({"doc": "at_doc", "text_hash": "at_hash"})
    matches = (F.col("doc") == F.col("at_doc")) & (F.col("text_hash") == F.col("at_hash"))
    first = rows.join(found, matches, "left").select("doc_id", "doc", "text_hash", "text", *LISTS)
    first = written(first.mapInArrow(_first_cut, FIRST), "suffix-first")

    done = first.where("raw is null").select("doc_id", *_RESULT_NAMES)
    pending = first.where("raw is not null")
    open_ = pending.select("doc", "text_hash", F.explode("open").alias("s")).select("doc", "text_hash", "s.*")
    n_open = open_.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    hot = open_.groupBy(F.col("core").alias("hot")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("hot")
    hot = written(hot, "suffix-hot")
    n_hot = hot.count()
    is_hot = F.col("core") == F.col("hot")
    cold = open_.join(small(hot, n_hot), is_hot, "left_anti") if n_hot else open_
    starts = _sorted_starts(cold, int(max(partitions, n_open // BYTES_PER_SORT)))
    if n_hot:
        starts = starts.unionByName(_hot_starts(open_.join(small(hot, n_hot), is_hot, "left_semi")))
    per_doc = starts.groupBy("doc", "text_hash").agg(F.flatten(F.collect_list("starts")).alias("found"))
    per_doc = written(per_doc, "suffix-starts").withColumnsRenamed({"doc": "at_doc", "text_hash": "at_hash"})
    second = pending.join(per_doc, matches, "left").select("doc_id", "raw", "marks", "found").mapInArrow(_second_cut, FINAL)
    return done.unionByName(second)
