"""Removing word passages that occur earlier, by automata of the repeated phrases.

A phrase is ``LENGTH`` consecutive words. Phrases are filed by their core, the ``CORE`` words in
them with the smallest hash; a segment is a run of phrases of a document with the same core.
Equal phrases have equal cores, so a core that stands once in all documents needs no second look.

* Documents are written as blocks, rows of some megabytes, which later steps find by number.
* Each block sends its distinct cores to shards, and each shard answers which of them recur.
* The recurring cores' segments, equal ones of a block once, are dealt by core. A task confirms
  which of their phrases recur, compiles these into Aho-Corasick automata over word numbers,
  a bounded number of phrases each, and streams all segments with these cores through them.
  The automata locate every occurrence, and the earliest place of a phrase is where it stays.
* Blocks get the verdicts on their segments and drop the words of phrases that came earlier.

Text is read in blocks and never shuffled as a whole: blocks are bucketed by number, and what goes
between them and the shards is cores, recurring segments and bit masks.

A core of more than ``HOT`` occurrences, such as one that a third of all documents share, would
bring as many different surroundings to one task. Its segments are cut into single phrases,
filed each by itself, so that only equal phrases meet, one row for each block.

Edge cases: null and empty texts have no words. Documents without id count as later than any
other. Among rows with equal ids the smaller text hash counts as earlier; rows equal in both
are one document and are treated alike. Long texts are whole, in a block of their own if they
are larger than one. An empty table gives an empty result. Columns other than id and text are
not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain, compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import DataFrame

from rampline.llm.common import shared_folder, written

LENGTH = 20
CORE = 8
NO_ID = 2**63 - 1
BLOCK_BYTES = 4_000_000
BLOCKS_PER_BUCKET = 8
BYTES_PER_SHARD = 24_000_000
HOT = 2_000
PHRASES_AT_ONCE = 60_000  # compared together, besides those of the last core
PHRASES_COMPILED = 1_000  # of one automaton, which a core's cache holds, besides those of its last core


# ---- words, cores, segments -----------------------------------------------------------


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A number per word, from eight of its bytes at a time."""
    raw = b" ".join(words) + bytes(8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(sizes + 1) - sizes - 1
    eights = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
    hashes, open_, done = np.zeros(len(words), np.uint64), np.arange(len(words)), 0
    while len(open_):
        left = np.minimum(sizes[open_] - done, 8).astype(np.uint64)
        part = eights[begin[open_] + done] << (np.uint64(64) - np.uint64(8) * left)
        hashes[open_] = _scrambled(hashes[open_] * np.uint64(0x9E3779B97F4A7C15) + part + left)
        done += 8
        open_ = open_[sizes[open_] > done]
    return hashes


def _gram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each word on."""
    hashes, held = _scrambled(words), 1
    while held < width:
        step = min(held, width - held)
        hashes = _scrambled(hashes[:-step] * np.uint64(0xD6E8FEB86659FD93) + hashes[step:])
        held += step
    return hashes


class Segments(NamedTuple):
    begin: np.ndarray  # first word
    phrases: np.ndarray  # how many phrases, from the first word on
    key: np.ndarray  # hash of the core

    def taken(self, which: np.ndarray) -> Segments:
        return Segments(*(column[which] for column in self))


def segments(hashes: np.ndarray, sizes: np.ndarray) -> Segments:
    """The segments of texts end to end, whose words have these hashes."""
    n = len(hashes) - LENGTH + 1
    if n <= 0:
        return Segments(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    least = cores = _gram_hashes(hashes, CORE)
    at, width, most = np.arange(len(cores), dtype=np.int64), 1, LENGTH - CORE + 1
    while width < most:  # the leftmost smallest of the next ``width`` hashes, for growing widths
        step = min(width, most - width)
        left = least[:-step] <= least[step:]
        at, least = np.where(left, at[:-step], at[step:]), np.where(left, least[:-step], least[step:])
        width += step
    doc = np.repeat(np.arange(len(sizes)), sizes)[:n]
    inside = np.arange(n) + LENGTH <= np.cumsum(sizes)[doc]
    new = np.ones(n, bool)
    new[1:] = (at[1:n] != at[: n - 1]) | ~inside[:-1]
    begin = np.flatnonzero(new & inside)
    stop = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))
    return Segments(begin, stop - begin + 1, cores[at[begin]])


def single_phrases(found: Segments, hashes: np.ndarray) -> Segments:
    """Each phrase of the segments as a segment, filed by itself."""
    begin = np.repeat(found.begin, found.phrases)
    begin += np.arange(len(begin)) - np.repeat(np.cumsum(found.phrases) - found.phrases, found.phrases)
    if not len(begin):
        return found
    return Segments(begin, np.ones(len(begin), np.int64), _gram_hashes(hashes, LENGTH)[begin])


class Block:
    """The words of one block's texts end to end."""

    def __init__(self, texts: list[str | None]) -> None:
        words = [(text or "").encode().split() for text in texts]
        self.sizes = np.array([len(own) for own in words], np.int64)
        self.words = list(chain.from_iterable(words))
        self.hashes = word_hashes(self.words)
        self.ends = np.cumsum(self.sizes)
        self.segments = segments(self.hashes, self.sizes)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct cores and how often they occur here, a large number cut."""
        keys, counts = np.unique(self.segments.key, return_counts=True)
        return keys, np.minimum(counts, 65_535).astype("<u2")

    def recurring(self, again: np.ndarray, hot: np.ndarray) -> Segments:
        """Segments of the cores that occur elsewhere, those of hot cores as single phrases."""
        found = self.segments.taken(np.isin(self.segments.key, again))
        is_hot = np.isin(found.key, hot)
        parts = found.taken(~is_hot), single_phrases(found.taken(is_hot), self.hashes)
        return Segments(*(np.concatenate(column) for column in zip(*parts, strict=True)))

    def contents(self, found: Segments) -> list[bytes]:
        ends = found.begin + found.phrases + (LENGTH - 1)
        return [b" ".join(self.words[b:e]) for b, e in zip(found.begin.tolist(), ends.tolist(), strict=True)]

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")


def _distinct(found: Segments, names: np.ndarray, docs: np.ndarray, hashes: np.ndarray, at: np.ndarray) -> tuple:
    """An order of the segments by key, name and place, and which of them are the first with key and name."""
    order = np.lexsort((at, hashes, docs, names, found.key))
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(found.key[order]) != 0) | (np.diff(names[order]) != 0)
    return order, first


def _names(contents: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, contents), np.uint64, len(contents))


# ---- blocks ---------------------------------------------------------------------------


def _blocked(block_bytes: int):
    def into_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng()  # blocks are written once, so any number of their own will do
        names = ["doc_id", "doc", "text_hash", "text"]

        def block(parts: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
            columns = [pa.concat_arrays([part[name] for part in parts]) for name in names]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column) for column in columns]
            number = pa.array([int(random.integers(2**63))], pa.int64())
            return pa.RecordBatch.from_arrays([number, pa.array([size], pa.int64()), *lists], ["block", "n_bytes", *names])

        parts, held = [], 0
        for batch in batches:
            sizes = np.array([len(text.as_buffer() or b"") if text.is_valid else 0 for text in batch["text"]], np.int64)
            begin = 0
            for at, size in enumerate(sizes.tolist()):
                if held and held + size > block_bytes:
                    parts.append(batch.slice(begin, at - begin))
                    yield block(parts, held)
                    parts, held, begin = [], 0, at
                held += size
            parts.append(batch.slice(begin))
        if any(part.num_rows for part in parts):
            yield block(parts, held)

    return into_blocks


def blocked(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The documents as rows of many, bucketed by their number, and the bytes of all texts."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, n_bytes // (block_bytes * BLOCKS_PER_BUCKET))
    schema = f"block long, n_bytes long, doc_id array<{kind}>, doc array<long>, text_hash array<long>, text array<string>"
    name = f"llm_phrase_blocks_{uuid.uuid4().hex}"
    writer = rows.mapInArrow(_blocked(block_bytes), schema).write.option("compression", "zstd")
    writer = writer.option("path", shared_folder(spark, "phrase-blocks"))
    writer.bucketBy(buckets, "block").format("parquet").saveAsTable(name)
    return spark.table(name), n_bytes


# ---- cores that recur -----------------------------------------------------------------

CORES = "shard int, block long, cores binary, counts binary"


def _cores(shards: int):
    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, texts in zip(batch["block"].to_pylist(), batch["text"], strict=True):
                keys, counts = Block(texts.values.to_pylist()).keys()
                shard = (keys % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                rows = [
                    (int(shard[own[0]]), number, keys[own].astype("<u8").tobytes(), counts[own].tobytes())
                    for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1)
                    if len(own)
                ]
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                columns = zip(*rows, strict=True) if rows else ((),) * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["shard", "block", "cores", "counts"]
                )

    return cores


ANSWERS = "block long, again binary, hot binary"


def _answers(most: int):
    """Rows come by shard. Per block those of its cores that occur more than once, and those that are hot."""

    def answered(rows: list[dict]) -> pa.RecordBatch:
        cores = [np.frombuffer(row["cores"], "<u8") for row in rows]
        counts = np.concatenate([np.frombuffer(row["counts"], "<u2") for row in rows]).astype(np.int64)
        _, at = np.unique(np.concatenate(cores), return_inverse=True)
        total = np.bincount(at, counts)
        bounds = np.cumsum([len(own) for own in cores])[:-1]
        again, hot = (np.split(total[at] > least, bounds) for least in (1, most))
        found = [
            (row["block"], own[a].tobytes(), own[h].tobytes())
            for row, own, a, h in zip(rows, cores, again, hot, strict=True)
            if a.any()
        ]
        columns = zip(*found, strict=True) if found else ((),) * 3
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["block", "again", "hot"]
        )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["shard"] != rows[0]["shard"]:
                    yield answered(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield answered(rows)

    return answer


def _numbers(lists: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(lists or []), "<u8")


# ---- automata -------------------------------------------------------------------------

SHARED = "key long, name long, content string, block long, doc long, text_hash long, at int, n int"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct segments of each block whose cores recur, with the first place of each in the block."""
    for batch in batches:
        columns = ("block", "doc", "text_hash", "text", "again", "hot")
        for number, docs, hashes, texts, again, hot in zip(*(batch[c].to_pylist() for c in columns), strict=True):
            if not again:
                continue
            block = Block(texts)
            found = block.recurring(_numbers(again), _numbers(hot))
            contents = block.contents(found)
            names, of = _names(contents), block.doc_of(found.begin)
            at = found.begin - (block.ends - block.sizes)[of]
            docs, hashes = np.array(docs, np.int64)[of], np.array(hashes, np.int64)[of]
            order, first = _distinct(found, names, docs, hashes, at)
            n = np.diff(np.append(np.flatnonzero(first), len(order)))
            order = order[first]
            arrays = [
                pa.array(found.key[order].view(np.int64)),
                pa.array(names[order].view(np.int64)),
                pa.array([contents[k] for k in order.tolist()], pa.string()),
                pa.array(np.full(len(order), number, np.int64)),
                pa.array(docs[order]),
                pa.array(hashes[order]),
                pa.array(at[order].astype(np.int32)),
                pa.array(n.astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "name", "content", "block", "doc", "text_hash", "at", "n"])


def compiled(phrases: Iterator[tuple[int, ...]]):
    """An automaton that finds the phrases, each with its number; None for no phrase."""
    import ahocorasick

    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for number, phrase in enumerate(phrases):
        automaton.add_word(phrase, number)
    if not len(automaton):
        return None
    automaton.make_automaton()
    return automaton


def _whole_cores(cores: np.ndarray, at_once: int) -> list[int]:
    """Where to cut a row of cores, equal ones in a row, into parts of about so many."""
    cuts, new = [0], np.flatnonzero(np.diff(cores)) + 1
    while cuts[-1] < len(cores):
        at = np.searchsorted(new, cuts[-1] + at_once)
        cuts.append(int(new[at]) if at < len(new) else len(cores))
    return cuts


def located(
    contents: list[bytes], weights: np.ndarray, cores: np.ndarray | None = None, compiled_at_once: int = PHRASES_COMPILED
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every occurrence of every phrase that the texts, occurring so often each, hold more than once.

    Returned are the phrases' numbers, the texts, and the places in these. Texts of one core, given
    in a row, share no phrase with others, so an automaton is made for some cores at a time. Texts
    without a phrase to look for are not streamed.
    """
    numbers: dict[bytes, int] = {}
    texts = [tuple([numbers.setdefault(word, len(numbers)) for word in content.split()]) for content in contents]
    sizes = np.array([len(text) for text in texts], np.int64)
    words = np.fromiter((word for text in texts for word in text), np.int64, int(sizes.sum()))
    of = np.repeat(np.arange(len(texts)), sizes)
    starts = np.flatnonzero(np.arange(len(words)) + LENGTH <= np.cumsum(sizes)[of])
    hashes = _gram_hashes(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15), LENGTH)[starts]
    _, first, at = np.unique(hashes, return_index=True, return_inverse=True)
    again = np.bincount(at, weights[of[starts]]) > 1
    base = np.cumsum(sizes) - sizes
    # phrases by the text that has them first, so that those of a core are in a row
    firsts = np.sort(first[again])
    places = [(int(of[k]), int(k - base[of[k]])) for k in starts[firsts].tolist()]
    holds = np.zeros(len(texts), bool)
    holds[of[starts[again[at]]]] = True
    core = np.zeros(len(texts), np.int64) if cores is None else np.cumsum(np.diff(cores, prepend=cores[:1]) != 0)
    cuts = _whole_cores(core[of[starts[firsts]]], compiled_at_once)
    hits = []
    for begin, end in zip(cuts, cuts[1:]):
        automaton = compiled(texts[text][at : at + LENGTH] for text, at in places[begin:end])
        own = core[[places[begin][0], places[end - 1][0]]]
        low, high = np.searchsorted(core, own[0]), np.searchsorted(core, own[1], "right")
        for k in (low + np.flatnonzero(holds[low:high])).tolist():
            hits += [(begin + number, k, stop - (LENGTH - 1)) for stop, number in automaton.iter(texts[k])]
    return tuple(np.array(hits, np.int64).reshape(-1, 3).T)


VERDICTS = "block long, key long, name long, gone int, at_first int"


def _located(at_once: int):
    """Rows come by key, name and place. Per segment and block the phrases that go.

    ``gone`` has a bit for each phrase of the segment that occurs elsewhere too, ``at_first``
    one for each that goes from the segment's first place in the block as well.
    """

    def verdicts(table: pa.Table) -> pa.RecordBatch:
        key, name, block, doc, text_hash, at, n = (
            table[c].to_numpy() for c in ("key", "name", "block", "doc", "text_hash", "at", "n")
        )
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
        first = np.flatnonzero(new)
        contents = table["content"].take(pa.array(first)).cast(pa.binary()).to_pylist()
        phrase, text, offset = located(contents, np.add.reduceat(n.astype(np.int64), first), key[first])
        begin = at[first].astype(np.int64)
        order = np.lexsort((begin[text] + offset, text_hash[first][text], doc[first][text], phrase))
        phrase, text, offset = phrase[order], text[order], offset[order]
        earliest = np.ones(len(phrase), bool)
        earliest[1:] = phrase[1:] != phrase[:-1]
        gone, spared = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        np.bitwise_or.at(gone, text, 1 << offset)
        np.bitwise_or.at(spared, text[earliest], 1 << offset[earliest])
        row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
        # a row that has the place of the first one holds the earliest occurrences
        same = (doc == doc[first][row]) & (text_hash == text_hash[first][row]) & (at == at[first][row])
        at_first = np.where(same, gone[row] & ~spared[row], gone[row])
        use = gone[row] > 0
        columns = (block, key, name, gone[row].astype(np.int32), at_first.astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(c[use]) for c in columns], ["block", "key", "name", "gone", "at_first"])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch["key"].to_numpy()
            new = np.flatnonzero(np.append(last is not None and key[0] != last, np.diff(key) != 0))
            begin, last = 0, key[-1]
            while True:  # whole cores only
                wanted = begin + (at_once - held) // (LENGTH - CORE + 1)
                cut = np.searchsorted(new, max(wanted, begin + (not waiting)))
                if cut == len(new):
                    break
                waiting.append(batch.slice(begin, new[cut] - begin))
                yield verdicts(pa.Table.from_batches(waiting))
                waiting, held, begin = [], 0, int(new[cut])
            waiting.append(batch.slice(begin))
            held += (batch.num_rows - begin) * (LENGTH - CORE + 1)
        if waiting:
            yield verdicts(pa.Table.from_batches(waiting))

    return locate


# ---- documents ------------------------------------------------------------------------


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each document of a block."""

    def marked(block: Block, docs, hashes, again, hot, verdicts: list[dict]) -> np.ndarray:
        found = block.recurring(_numbers(again), _numbers(hot))
        names, of = _names(block.contents(found)), block.doc_of(found.begin)
        place = (np.array(docs, np.int64)[of], np.array(hashes, np.int64)[of], found.begin - (block.ends - block.sizes)[of])
        order, first = _distinct(found, names, *place)
        # rows that are equal are one document: all of their segments stand at the first place
        place = np.stack(place, 1)[order]
        head = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        at_first = (place == place[head]).all(1)
        masks = {(v["key"], v["name"]): (v["gone"], v["at_first"]) for v in verdicts}
        pairs = zip(found.key[order].view(np.int64).tolist(), names[order].view(np.int64).tolist(), strict=True)
        both = np.array([masks.get(pair, (0, 0)) for pair in pairs], np.int64).reshape(-1, 2)
        mask, begin = np.where(at_first, both[:, 1], both[:, 0]), found.begin[order]
        delta = np.zeros(len(block.words) + 1, np.int64)
        for k in range(LENGTH - CORE + 1):
            starts = begin[mask >> k & 1 == 1] + k
            np.add.at(delta, starts, 1)
            np.add.at(delta, starts + LENGTH, -1)
        return np.cumsum(delta[:-1]) > 0

    for batch in batches:
        columns = ("doc", "text_hash", "text", "again", "hot", "verdicts")
        for at, (docs, hashes, texts, again, hot, verdicts) in enumerate(
            zip(*(batch[c].to_pylist() for c in columns), strict=True)
        ):
            block = Block(texts)
            stays = np.ones(len(block.words), bool)
            if verdicts:
                stays = ~marked(block, docs, hashes, again, hot, verdicts)
            before = np.concatenate([[0], np.cumsum(stays)])
            left = before[block.ends] - before[block.ends - block.sizes]
            kept, stays = [], stays.tolist()
            for end, size, n in zip(block.ends.tolist(), block.sizes.tolist(), left.tolist(), strict=True):
                own = block.words[end - size : end]
                kept.append(b" ".join(own if n == size else compress(own, stays[end - size : end])))
            ids = batch["doc_id"][at].values
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(block.sizes), pa.array(block.sizes - left), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )


def removed(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hot: int = HOT, at_once: int = PHRASES_AT_ONCE) -> DataFrame:
    """Per document its words, those removed, and the rest of them joined by a space."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks, n_bytes = blocked(docs, block_bytes)
    shards = int(max(partitions, n_bytes // BYTES_PER_SHARD))
    cores = blocks.select("block", "text").mapInArrow(_cores(shards), CORES)
    answers = cores.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_answers(hot), ANSWERS)
    answers = answers.groupBy("block").agg(F.collect_list("again").alias("again"), F.collect_list("hot").alias("hot"))
    answers = written(answers, "phrase-cores")
    shared = blocks.join(answers.hint("shuffle_hash"), "block").mapInArrow(_shared, SHARED)
    verdicts = shared.repartition(shards, "key").sortWithinPartitions("key", "name", "doc", "text_hash", "at")
    verdicts = verdicts.mapInArrow(_located(at_once), VERDICTS)
    verdicts = verdicts.groupBy("block").agg(F.collect_list(F.struct("key", "name", "gone", "at_first")).alias("verdicts"))
    told = written(answers.join(verdicts, "block"), "phrase-verdicts")
    return blocks.join(told.hint("shuffle_hash"), "block", "left").mapInArrow(
        _kept, f"doc_id {kind}, n_words long, n_removed long, kept string"
    )


def digests(docs: DataFrame) -> DataFrame:
    """``removed`` with a digest of what is kept in its place."""
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return removed(docs).select("doc_id", "n_words", "n_removed", kept)
