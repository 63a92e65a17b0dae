import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rampline.llm import suffix_sort, suffixes

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("limits", [(200_000, 4_000_000), (5, 20), (1, 3)])
@given(st.lists(st.integers(1, 4), max_size=80), st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_sorted_suffixes(limits, symbols, times):
    suffix_sort.ITEMS_PER_BIN, suffix_sort.ITEMS_IN_MEMORY = limits
    try:
        text = [*symbols * times, 0]
        got = np.concatenate(list(suffix_sort.sorted_suffixes(np.array(text))))
    finally:
        suffix_sort.ITEMS_PER_BIN, suffix_sort.ITEMS_IN_MEMORY = 200_000, 4_000_000
    assert got.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_each_string_lies_in_one_segment():
    random = np.random.default_rng(0)
    texts = [bytes(random.integers(97, 100, n).astype(np.uint8)) for n in (0, 49, 50, 51, 400, 30, 900)] + [b"!" * 300]
    raw, found = suffixes.segments(texts)
    begins = np.cumsum([0, *map(len, texts[:-1])])
    want = [int(b) + i for b, t in zip(begins, texts, strict=True) for i in range(len(t) - 49)]
    got = [p for b, e in zip(found.begin, found.end, strict=True) for p in range(b, e - 49)]
    assert got == want
    # and equal strings are filed under the same anchor
    anchors = {}
    for b, e, a in zip(found.begin, found.end, found.anchor, strict=True):
        for p in range(b, e - 49):
            assert anchors.setdefault(raw[p : p + 50], a) == a


def brute(rows):
    texts = [((d if d is not None else suffixes.NO_ID), (t or "").encode()) for d, t in rows]
    least = {}
    for doc, text in texts:
        for p in range(len(text) - 49):
            s = text[p : p + 50]
            least[s] = min(doc, least.get(s, doc))
    out = []
    for (doc, text), (doc_id, _) in zip(texts, rows, strict=True):
        gone = [False] * len(text)
        for p in range(len(text) - 49):
            if least[text[p : p + 50]] < doc:
                gone[p : p + 50] = [True] * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    got = suffixes.removed(spark.createDataFrame(rows, SCHEMA).repartition(3))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows_got = got.collect()
    assert sorted((tuple(r[n] for n in names) for r in rows_got), key=str) == brute(rows)
    for r in rows_got:
        assert sum(e - b for b, e in zip(r.begins, r.ends, strict=True)) == r.n_removed and len(r.begins) == r.n_spans


def words(random, n):
    return " ".join("".join(chr(97 + c) for c in random.integers(0, 26, random.integers(2, 9))) for _ in range(n))


def test_shared_passages(spark):
    random = np.random.default_rng(4)
    passages = [words(random, 30) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [words(random, int(random.integers(1, 20))) for _ in range(4)]
        for at in random.integers(0, 5, random.integers(0, 4)):
            cut = random.integers(0, 60, 2)
            parts.insert(int(at) % len(parts), passages[int(random.integers(0, 6))][cut[0] : len(passages[0]) - cut[1]])
        rows.append((int(random.integers(0, 100)), "".join(parts)))
    base = words(random, 200).split()
    for i in range(40):  # near copies
        copy = list(base)
        for at in random.integers(0, 200, 5):
            copy[at] = words(random, 1)
        rows.append((200 + i, " ".join(copy)))
    check(spark, rows)


def test_odd_texts(spark):
    fifty, run = "0123456789" * 5, "!" * 130
    rows = [
        (5, fifty), (4, fifty + "x"), (3, "y" + fifty[:49]), (9, fifty + fifty), (1, None), (2, ""), (7, run), (6, run[:50]), (8, run + fifty + run),
        (None, fifty), (None, run + "tail of one without id that is long enough to be fifty bytes"), (None, "tail of one without id that is long enough to be fifty bytes"),
        (10, "é" * 60), (11, "é" * 40 + "x"), (12, "aé" * 30), (5, fifty), (5, fifty + "other text under the same id"), (13, "ab" * 40), (14, "ba" * 40 + "\0\0"),
        (15, "long " * 20_000), (16, "x" + "long " * 3000),
    ]
    check(spark, rows)


def test_small_chunks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BYTES_AT_ONCE", 300)
    monkeypatch.setattr(suffixes, "SEGMENTS_PER_BLOCK", 20)
    monkeypatch.setattr(suffixes, "BYTES_PER_SHARD", 500)
    random = np.random.default_rng(8)
    shared = words(random, 40)
    check(spark, [(i, words(random, 5) + shared[i : 150 + i] + words(random, 5)) for i in range(40)])


@pytest.mark.parametrize("hot", [1, 30, 2_000])
def test_hot_passages(spark, monkeypatch, hot):
    """Passages around the length of a string, in many documents with different surroundings."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    random = np.random.default_rng(6)
    long = words(random, 30)
    rows = [(int(random.integers(0, 150)), words(random, 4) + long[:size] + words(random, 4) + "##" + long[:size]) for size in (30, 41, 49, 50, 53, 70) for _ in range(30)]
    rows += [(None, long[:60]), (3, long[5:58]), (500, long)]
    check(spark, rows)


def test_empty_table_and_clashing_columns(spark):
    assert suffixes.removed(spark.createDataFrame([], SCHEMA)).count() == 0
    extra = spark.createDataFrame([(1, "a" * 60, 5, "k"), (2, "a" * 60, 5, "k")], SCHEMA + ", doc int, raw string")
    assert sorted((r.doc_id, r.n_removed) for r in suffixes.removed(extra).collect()) == [(1, 0), (2, 60)]
