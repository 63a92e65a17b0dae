from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rampline.llm import simhash
from rampline.llm.components import components, local_roots

SCHEMA = "doc_id long, text string, source string"


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(x) for x in range(n)]


@given(st.text(alphabet="aB \n\té ", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_every_word_is_near_one_codeword():
    _, _, error, near = simhash.golay_tables()
    assert (np.bitwise_count(error) <= 3).all() and len(set(error.tolist())) == 2048
    assert all(len(set(row.tolist())) == 5 for row, e in zip(near, error, strict=True) if int(e).bit_count() == 3)


def test_neighbours_share_a_codeword():
    words = np.random.default_rng(1).integers(0, 1 << 23, 20_000)
    flipped = words ^ (1 << np.random.default_rng(2).integers(0, 23, len(words)))
    mine, theirs = [set() for _ in words], [set() for _ in words]
    for found, sets in ((simhash.golay_keys(words), mine), (simhash.golay_keys(flipped), theirs)):
        for row, key in zip(*found, strict=True):
            sets[row].add(int(key))
    assert all(a & b for a, b in zip(mine, theirs, strict=True))
    assert {len(s) for s in mine} == {1, 6}


@given(st.integers(1, 30), st.data())
@settings(max_examples=50)
def test_local_roots(n, data):
    pairs = data.draw(st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1)), max_size=40))
    left, right = np.array(pairs, int).reshape(-1, 2).T
    assert local_roots(n, left, right).tolist() == roots(n, pairs)


def test_components(spark):
    random = np.random.default_rng(5)
    path = [(i, i + 1) for i in range(60)]
    star = [(100, 101 + i) for i in range(80)]
    loose = [(int(a), int(b)) for a, b in random.integers(200, 400, (110, 2))]
    pairs = path + star + loose
    want = {n: r for n, r in enumerate(roots(400, pairs)) if n != r}
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == want


@pytest.mark.parametrize("limit", [64, 4])
@pytest.mark.parametrize("all_pairs", [100_000, 10])
def test_links_are_complete(spark, monkeypatch, limit, all_pairs):
    monkeypatch.setattr(simhash, "RUN_BY_SHIFTS", limit)
    monkeypatch.setattr(simhash, "ALL_PAIRS_UP_TO", all_pairs)
    random = np.random.default_rng(limit)
    centres = random.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(25):
            bits = random.choice(64, random.integers(1, 5), replace=False)
            fps.add(int(c) ^ sum(1 << int(b) for b in bits))
    fps = sorted(fps)
    key = np.zeros(len(fps), np.int64)
    near = [(i, j) for i, j in combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 2]
    want = roots(len(fps), near)
    # through the keys, as the job does
    batch = simhash.pa.RecordBatch.from_arrays([simhash.pa.array(np.array(fps, np.uint64).view(np.int64))], ["fp"])
    rows = [r for b in simhash._keys(iter([batch])) for r in zip(b["key"].to_pylist(), b["fp"].to_pylist(), strict=True)]
    place = {fp if fp < 1 << 63 else fp - (1 << 64): i for i, fp in enumerate(fps)}
    rows.sort()
    parts = [rows[i : i + 37] for i in range(0, len(rows), 37)]
    batches = [simhash.pa.RecordBatch.from_arrays([simhash.pa.array(c) for c in zip(*p, strict=True)], ["key", "fp"]) for p in parts]
    edges = [(place[a], place[b]) for s in simhash._links(("fp",), 2)(iter(batches)) for a, b in zip(s["a"].to_pylist(), s["b"].to_pylist(), strict=True)]
    assert roots(len(fps), edges) == want
    assert len(key) == len(fps)


TEXT = "the quick brown fox jumps over the lazy dog and runs far away from all of the hunters in the dark wood"


def brute(rows):
    prints = [plain_fingerprint(text) for _, text, _ in rows]
    near = [(i, j) for i, j in combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 2]
    root = roots(len(rows), near)
    least = {}
    for (doc, _, _), r in zip(rows, root, strict=True):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted(((d, f"{p:016x}", least.get(r)) for (d, _, _), p, r in zip(rows, prints, root, strict=True)), key=str)


ROWS = [
    (7, TEXT, "a"), (3, TEXT, "a"), (3, TEXT, "a"), (None, TEXT, "b"), (5, TEXT.upper(), None),
    (8, None, "a"), (9, "", "a"), (10, " \n\t", "a"), (11, "one two", "a"), (None, "without any id at all here", "a"),
    (12, TEXT + " " + TEXT, "a"), (13, "x" * 50_000 + " y z w", "a"), (14, "something else entirely unlike the others", "a"),
]


def test_components_of(spark):
    got = simhash.components_of(spark.createDataFrame(ROWS, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = simhash.kept_only(docs)
    assert kept.columns == docs.columns
    # copies go, whatever their case; texts without words are copies of each other
    want = [(3,), (8,), (11,), (None,), (12,), (13,), (14,)]
    found = {r.doc_id for r in kept.collect()}
    assert {3, 8, 11, None, 13, 14} <= found <= {w[0] for w in want}
    assert kept.count() == len(found)


def test_near_copies_go_and_others_stay(spark):
    """What stays is the smallest id of each component of fingerprints up to two bits apart, over long and short texts."""
    random = np.random.default_rng(21)
    words = ["".join(chr(97 + c) for c in random.integers(0, 26, 5)) for _ in range(4000)]
    rows = []
    for group in range(150):
        n = int(random.integers(30, 1500))
        base = list(random.choice(words, n))
        rows.append((3 * group, " ".join(base), "base"))
        changed, far = list(base), list(base)
        changed[int(random.integers(0, n))] = "changed"
        for at in random.choice(n, n // 8, replace=False):
            far[at] = "other"
        rows.append((3 * group + 1, " ".join(changed), "near"))
        rows.append((3 * group + 2, " ".join(far), "far"))
    want = {d for d, _, component in brute(rows) if d == component}
    kept = {r.doc_id: r.source for r in simhash.kept_only(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(kept) == want
    assert list(kept.values()).count("base") == 150 and list(kept.values()).count("near") < 100
    assert list(kept.values()).count("far") > 145


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.components_of(empty).count() == 0
    assert simhash.kept_only(empty).count() == 0
    extra = spark.createDataFrame([(1, "a b c", 5, "k")], "doc_id long, text string, fp long, keeper string")
    assert simhash.kept_only(extra).collect() == extra.collect()
    with pytest.raises(ValueError):
        simhash.kept_only(extra.withColumnRenamed("fp", "_sim_doc"))
