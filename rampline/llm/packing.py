"""Packing documents into sequences along a space-filling curve.

The tokens of a document are hashed to a few dimensions; their mean is a point, and the
place of the point on a Hilbert curve is the document's key. Documents are range-sorted by
key, so neighbours on the curve, which are alike, meet in the same sequences. Each range is
filled on its own: its documents are laid end to end and cut at the sequence length, and
what is left at its end is cut into powers of two, which need no padding.

Edge cases: a null text is an empty one, and every document has at least the closing id.
Documents with equal keys, such as copies, are ordered by id and text hash, so a large
group of copies spreads over ranges. Very long texts are tokenized whole, one at a time. An
empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from rampline.llm.common import written

SEQUENCE = 1024
END_ID = 0
DIMENSIONS = 4
LEVELS = 8  # bits of the key for each dimension
SPREAD = 4.0  # standard deviations that the curve covers


def _ranked(ranks: str):
    """The tokenizer of a vocabulary as .tiktoken ranks, which knows no special tokens."""
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as file:
        mergeable = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=mergeable, special_tokens={})
    return encoding.encode_ordinary


@cache
def _encoder(vocabulary: str):
    """The ids of a text by a tokenizer's .json file.

    Where the same vocabulary lies beside it as .tiktoken ranks, these give the same ids several times
    as fast, but for texts that hold an added token of the file, which only the file's tokenizer splits off.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)

    def exact(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    ranks = f"{vocabulary.removesuffix('.json')}.tiktoken"
    if not os.path.exists(ranks):
        return exact
    fast = _ranked(ranks)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    if not added:
        return fast
    apart = re.compile("|".join(map(re.escape, added)))
    return lambda text: exact(text) if apart.search(text) else fast(text)


# ---- points and keys ------------------------------------------------------------------


@cache
def _directions(ids: int) -> np.ndarray:
    """A pseudo-random sign per token id and dimension, by hashing the id."""
    x = np.arange(1, ids + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    bits = (x[:, None] >> np.arange(DIMENSIONS, dtype=np.uint64)) & np.uint64(1)
    return (2.0 * bits.astype(np.float32) - 1.0).astype(np.float32)


def hilbert_key(cell: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """The place on the Hilbert curve of the integer points ``cell`` (points x dimensions), after Skilling (2004)."""
    x = cell.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(levels - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            on = x[i] & bit != 0
            swapped = (x[0] ^ x[i]) & low
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swapped)
            x[i] = np.where(on, x[i], x[i] ^ (0 if i == 0 else swapped))
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(levels - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level) != 0, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(levels - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | (x[i] >> level & 1)
    return key


def point(ids: np.ndarray) -> np.ndarray:
    """The cell of a document: its hashed vector, scaled to a unit of spread in each dimension."""
    table = _directions(1 << int(ids.max()).bit_length() if len(ids) else 1)
    vector = table[ids].sum(0, dtype=np.float64) / max(1.0, np.sqrt(len(ids)))
    side = 1 << LEVELS
    # vectors of long texts are far from the centre: their direction counts, so they are drawn in
    drawn = vector / np.sqrt(1.0 + (vector @ vector) / SPREAD**2)
    return np.clip(((drawn / SPREAD + 1.0) / 2.0 * side).astype(np.int64), 0, side - 1)


def _tokenized(vocabulary: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            ids, cells = [], []
            for text in batch["text"]:
                own = np.array(encoder(text.as_py() or ""), np.uint32)
                cells.append(point(own))
                ids.append(np.append(own, np.uint32(END_ID)).astype(np.uint32).tobytes())
            keys = hilbert_key(np.array(cells).reshape(-1, DIMENSIONS))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(keys, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "text_hash", "key", "ids"],
            )

    return encode


def tokenized(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text_hash, key, ids): the ids with the closing one as little-endian 32-bit numbers."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_tokenized(vocabulary), f"doc_id {kind}, text_hash long, key long, ids binary")


# ---- sequences ------------------------------------------------------------------------


def _cut(length: int) -> list[int]:
    """Sequence lengths for the tokens left at the end of a range: powers of two."""
    return [1 << bit for bit in range(length.bit_length() - 1, -1, -1) if length >> bit & 1]


class _Filler:
    """Lays documents end to end and yields the pieces of each sequence once its length is known."""

    def __init__(self, first_sequence: int, size: int) -> None:
        self.sequence, self.size, self.waiting, self.held = first_sequence, size, [], 0

    def add(self, doc: int, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            take = min(self.size - self.held, len(ids) - start)
            self.waiting.append((doc, start, ids[start : start + take], len(ids)))
            self.held, start = self.held + take, start + take
            if self.held == self.size:
                yield from self._sequences([self.size])

    def close(self) -> Iterator[tuple]:
        yield from self._sequences(_cut(self.held))

    def _sequences(self, lengths: list[int]) -> Iterator[tuple]:
        pieces, self.waiting, self.held = self.waiting[::-1], [], 0
        for length in lengths:
            offset = 0
            while offset < length:
                doc, start, ids, total = pieces.pop()
                take = min(length - offset, len(ids))
                if take < len(ids):
                    pieces.append((doc, start + take, ids[take:], total))
                yield doc, start, ids[:take], total, self.sequence, offset
                offset += take
            self.sequence += 1


PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def _filled(size: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filler = _Filler(TaskContext.get().partitionId() << 40, size)

        def rows(pieces: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            doc, start, ids, total, sequence, offset = zip(*pieces, strict=True) if pieces else ([],) * 6
            raw = [part.astype("<u4").tobytes() for part in ids]
            numbers = (start, [len(part) for part in ids], [zlib.crc32(part) for part in raw], total, sequence, offset)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, kind), *[pa.array(c, pa.int64()) for c in numbers], pa.array(raw, pa.binary())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            pieces = []
            for doc, ids in zip(batch["doc_id"].to_pylist(), batch["ids"], strict=True):
                pieces.extend(filler.add(doc, np.frombuffer(ids.as_buffer(), "<u4")))
                if len(pieces) >= 2000:
                    yield rows(pieces, kind)
                    pieces = []
            yield rows(pieces, kind)
        yield rows(list(filler.close()), kind)

    return fill


def packed(docs: DataFrame, vocabulary: str, size: int = SEQUENCE) -> DataFrame:
    """Per piece of a sequence its document, place, ids and their checksum.

    ``ids`` are the piece's ids as little-endian 32-bit numbers. Sequences are numbered by
    range, so numbers are unique but not gapless.
    """
    tokens = written(tokenized(docs, vocabulary), "pack-tokens")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = ("key", "doc_id", "text_hash")
    return (
        tokens.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "ids")
        .mapInArrow(_filled(size), f"doc_id {kind}, {PIECES}")
    )
