"""Periodic runs of words, found by an enhanced suffix array, and texts with the runs collapsed.

A run is a stretch of consecutive words that repeats itself with a smallest period, and that no
neighbouring word continues. It ends in one square (two copies of the period's words) that the
word after it breaks: the suffixes at both copies agree in exactly as many words as the period.
In the array of sorted suffixes such a pair lies in an interval of common prefixes of that
depth, the two in different children of it. So, for each interval, every suffix i of the smaller
children is tested: is the rank of i + depth, or of i - depth, within the other child? No tree is
built: intervals come from a stack over the array of common prefixes, and an interval of several
children is split at each of its boundaries in turn. Squares are then rotated to the left as far
as the words allow, which gives the whole run, and those that stem from one run merge: a run
found by a multiple of its period has the same ends and a longer period.

Ranks are those of prefix doubling, kept for each doubling, which also answer how far two places
agree, to the right and to the left. Words are numbered per document, so suffixes of different
documents have nothing in common, and many documents are worked on as one array.

A run of at least ``least`` words and ``exponent`` periods holds a stretch of least -
least/exponent words or more that its next period repeats. A document without two equal stretches
of that length has no such run, and needs no suffix array. That test compares hashes of
stretches: equal hashes of unequal stretches cost time only.

Edge cases: null and empty texts have no words and no runs. A document is worked on whole, with
some 150 bytes for each word; only its own length matters, not that of others. Rows are worked on
one by one, so ties, repeated rows and rows without id all give their own result. An empty table
gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from rampline.llm.common import let, words_of

LEAST = 24
EXPONENT = 3
WORDS_AT_ONCE = 200_000
TESTS_AT_ONCE = 2_000_000


# ---- suffix array ---------------------------------------------------------------------


def doubled_ranks(words: np.ndarray) -> list[np.ndarray]:
    """For widths 1, 2, 4 and so on: places with equal numbers agree in so many words.

    The last numbers are all different: they are the places' ranks among the sorted suffixes.
    Each array has one more place, with -1, for the end. Only places that are not told apart
    yet are sorted again.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    new = np.ones(n, bool)
    new[1:] = words[order[1:]] != words[order[:-1]]
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    shared = ~(new & np.append(new[1:], True))
    open_, found, width = order[shared], [rank], 1
    while len(open_):
        own = rank[open_].astype(np.int64)
        key = own * (n + 1) + rank[np.minimum(open_ + width, n)] + 1
        order = np.argsort(key, kind="stable")
        open_, own, key = open_[order], own[order], key[order]
        at = np.arange(len(open_))
        group = np.ones(len(open_), bool)
        group[1:] = own[1:] != own[:-1]
        new = np.ones(len(open_), bool)
        new[1:] = key[1:] != key[:-1]
        # a number is the place of the first equal suffix in the sorted order, so it only grows
        first = np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[open_] = own + np.maximum.accumulate(np.where(new, at, 0)) - first
        found.append(rank)
        open_ = open_[~(new & np.append(new[1:], True))]
        width *= 2
    return found


def agreement(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many words the suffixes at ``a`` and ``b`` agree from their start."""
    a, b, same = a.astype(np.int64), b.astype(np.int64), np.zeros(len(a), np.int64)
    n = len(ranks[0]) - 1
    for level in range(len(ranks) - 1, -1, -1):
        x, y = np.minimum(a + same, n), np.minimum(b + same, n)
        same += (ranks[level][x] == ranks[level][y]).astype(np.int64) << level
    return same


def agreement_before(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many words what stands before ``a`` agrees with what stands before the later ``b``."""
    same = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        x, y = a - same - (1 << level), b - same - (1 << level)
        same += ((x >= 0) & (ranks[level][np.maximum(x, 0)] == ranks[level][np.maximum(y, 0)])).astype(np.int64) << level
    return same


def _children(common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Boundaries within intervals of common prefixes, and where their left and right child begin and end.

    ``common[k]`` is what the suffixes ranked k - 1 and k have in common. The children at k are
    the ranks from ``left`` to k - 1 and from k to ``right`` - 1.
    """
    n = len(common)
    left, right = np.zeros(n, np.int64), np.full(n, n, np.int64)
    stack: list[int] = []
    lefts, rights = left.tolist(), right.tolist()
    depths = common.tolist()
    for k, depth in enumerate(depths):
        while stack and depths[stack[-1]] >= depth:
            rights[stack.pop()] = k
        lefts[k] = stack[-1] if stack else 0
        stack.append(k)
    at = np.flatnonzero(common > 0)
    return at, np.array(lefts, np.int64)[at], np.array(rights, np.int64)[at]


def _pieces(sizes: np.ndarray) -> Iterator[slice]:
    """Cuts a list of sizes where their sum passes a bound."""
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        passed = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, passed + TESTS_AT_ONCE, "right")))
        yield slice(begin, end)
        begin = end


def branching_squares(ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares that the word after them breaks."""
    rank = ranks[-1][:-1].astype(np.int64)
    n = len(rank)
    suffix = np.empty(n, np.int64)
    suffix[rank] = np.arange(n)
    common = np.zeros(n, np.int64)
    common[1:] = agreement(ranks, suffix[:-1], suffix[1:])
    at, left, right = _children(common)
    smaller_left = at - left <= right - at
    begin, size = np.where(smaller_left, left, at), np.where(smaller_left, at - left, right - at)
    low, high = np.where(smaller_left, at, left), np.where(smaller_left, right, at)
    starts, periods = [], []
    for piece in _pieces(size):
        of = np.repeat(np.arange(piece.start, piece.stop), size[piece])
        within = np.arange(len(of)) - np.repeat(np.cumsum(size[piece]) - size[piece], size[piece])
        i, depth = suffix[begin[of] + within], common[at[of]]
        for j in (i + depth, i - depth):
            inside = (j >= 0) & (j < n)
            other = rank[np.where(inside, j, 0)]
            hit = inside & (other >= low[of]) & (other < high[of])
            starts.append(np.minimum(i, j)[hit])
            periods.append(depth[hit])
    return np.concatenate(starts or [suffix[:0]]), np.concatenate(periods or [suffix[:0]])


# ---- runs -----------------------------------------------------------------------------


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeats_of(words: np.ndarray, width: int) -> np.ndarray:
    """Places whose next ``width`` words stand elsewhere too, by hash."""
    if len(words) <= width:
        return np.zeros(0, np.int64)
    hashes, held = _scrambled(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    while held < width:
        step = min(held, width - held)
        hashes = _scrambled(hashes[:-step] * np.uint64(0xD6E8FEB86659FD93) + hashes[step:])
        held += step
    order = np.argsort(hashes)
    again = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    return np.concatenate([order[again], order[again + 1]])


def shortest_repeat(least: int, exponent: int) -> int:
    """So many words of any run of ``least`` words and ``exponent`` periods are repeated a period later."""
    return min(max(least, exponent * period) - period for period in range(1, least + 1))


def runs_in(words: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows of start, length and smallest period, by start, then period. ``words`` are numbers."""
    if not len(words):
        return np.zeros((0, 3), np.int64)
    ranks = doubled_ranks(words)
    start, period = branching_squares(ranks)
    turned = agreement_before(ranks, start, start + period)
    found = np.stack([start - turned, 2 * period + turned, period], 1)
    found = found[found[:, 1] >= np.maximum(least, exponent * period)]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay if every run keeps its first period only."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, runs[:, 0] + runs[:, 2], 1)
    np.add.at(delta, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(delta[:-1]) == 0


def _runs_of_many(numbers: list[np.ndarray], least: int, exponent: int) -> list[np.ndarray]:
    """Runs of each of several documents, whose words are numbered from 0 each."""
    none = np.zeros((0, 3), np.int64)
    found = [none] * len(numbers)
    sizes = np.array([len(own) for own in numbers], np.int64)
    base = np.cumsum([0, *[int(own.max()) + 1 if len(own) else 0 for own in numbers]])
    words = np.concatenate([own + first for own, first in zip(numbers, base, strict=False)])
    doc = np.repeat(np.arange(len(numbers)), sizes)
    repeats = np.unique(doc[repeats_of(words, shortest_repeat(least, exponent))])
    if not len(repeats):
        return found
    words = words[np.isin(doc, repeats)]
    ends = np.cumsum(sizes[repeats])
    runs = runs_in(words, least, exponent)
    of = np.searchsorted(ends, runs[:, 0], "right")
    runs[:, 0] -= (ends - sizes[repeats])[of]
    for at, own in zip(repeats, np.split(runs, np.searchsorted(of, np.arange(1, len(repeats)))), strict=True):
        found[at] = own
    return found


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _collapse(least: int, exponent: int):
    def numbered(words: list[bytes]) -> np.ndarray:
        numbers: dict[bytes, int] = {}
        return np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)

    def collapsed(texts: list[list[bytes]], numbers: list[np.ndarray]) -> Iterator[tuple]:
        for words, runs in zip(texts, _runs_of_many(numbers, least, exponent), strict=True):
            kept = words
            if len(runs):
                kept = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))]
            rows = [dict(zip(("start", "length", "period"), run, strict=True)) for run in runs.tolist()]
            yield len(words), rows, b" ".join(kept)

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, numbers, held = [], [], [], 0
            for text in batch["text"]:
                texts.append((text.as_py() or "").encode().split())
                numbers.append(numbered(texts[-1]))
                held += len(texts[-1])
                if held >= WORDS_AT_ONCE:
                    rows.extend(collapsed(texts, numbers))
                    texts, numbers, held = [], [], 0
            if texts:
                rows.extend(collapsed(texts, numbers))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            kinds = (pa.int64(), _RUNS, pa.string())
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], ["doc_id", "n_words", "runs", "collapsed"])

    return collapse


def collapsed(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """Per row its id, number of words, runs by start and period, and its words but for the repeats, joined by a space."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_collapse(least, exponent), f"doc_id {kind}, {_FOUND}")


def digests(docs: DataFrame) -> DataFrame:
    """``collapsed`` with the run of the greatest exponent, and digests of runs and text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # runs come by start and period, so the first of equal exponents stays
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    most = F.aggregate(
        "runs",
        none,
        lambda best, r: F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
        ).otherwise(best),
    )
    return (
        collapsed(docs)
        .withColumn("most", most)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            *[F.col("most")[name].alias(name) for name in ("start", "length", "period")],
            F.floor(1000 * F.col("most.length") / F.col("most.period")).alias("exponent_milli"),
            F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )


def looped(docs: DataFrame) -> DataFrame:
    """Ids and texts; every tenth document by its id's CRC-32 repeats itself from some word on."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    turn = F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = turn % n
        p = 1 + F.floor((n - a) / (3 + turn % 8))
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, 1, a.cast("int")), tail), " "))

    text = F.when(number % 10 == 0, let(words_of(F.col("text")), repeated)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))
