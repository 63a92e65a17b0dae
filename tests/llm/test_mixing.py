import hashlib
from collections import defaultdict

import pytest

from rampline.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def words(n):
    return " ".join(["w"] * n)


def brute_targets(sizes, weights=(1, 2, 3)):
    """By sharing again and again until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, open_ = {}, set(names)
    while open_:
        rest = sum(sizes.values()) - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in above}
        open_ -= above
    return fixed


def brute(rows):
    hashed = lambda d, t: int(hashlib.md5(f"{'' if d is None else d}|{t or ''}".encode()).hexdigest()[:15], 16)
    by_source = defaultdict(list)
    for d, t, s in rows:
        by_source[s].append((hashed(d, t), d, len((t or "").split())))
    sizes = {s: sum(n for _, _, n in own) for s, own in by_source.items()}
    targets = brute_targets(sizes)
    out = []
    for s, own in by_source.items():
        passes = int(targets[s] // sizes[s]) if sizes[s] else 0
        rest, before = targets[s] - passes * sizes[s], 0
        for _, d, n in sorted(own):
            extra = before + n / 2 <= rest
            before += n
            out.append((d, n, sizes[s], round(targets[s], 6), n * (passes + extra)))
    return sorted(out, key=str)


ROWS = [(i, words(i * 7 % 40), f"s{i % 5}") for i in range(300)] + [
    (300, None, "s1"), (301, "", None), (302, words(15), None), (303, words(3), "Z"), (304, words(5000), "s0"),
    (305, " \n", "only blanks"), (None, words(9), "s2"), (None, words(11), "s2"),
]


def test_taken(spark):
    got = mixing.taken(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got), key=str) == brute(ROWS)


def test_each_source_comes_near_its_target(spark):
    got = mixing.taken(spark.createDataFrame(ROWS, SCHEMA)).collect()
    largest = defaultdict(int)
    taken = defaultdict(int)
    for r in got:
        key = (r.source_size, r.target)
        taken[key] += r.taken
        largest[key] = max(largest[key], r.size)
        assert r.taken <= 3 * r.size
    assert all(abs(taken[k] - k[1]) <= largest[k] / 2 + 1e-6 for k in taken)


def test_mixed_repeats_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    counts = defaultdict(int)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        counts[r.doc_id] += len((r.text or "").split())
    want = defaultdict(int)
    for doc, _, _, _, n in brute(ROWS):
        want[doc] += n
    assert {d: n for d, n in counts.items() if n} == {d: n for d, n in want.items() if n}


def test_a_group_of_equal_rows_is_split(spark):
    rows = [(None, words(10), "a")] * 3000 + [(i, words(10), "b") for i in range(900)]
    got = mixing.taken(spark.createDataFrame(rows, SCHEMA)).collect()
    for size in {r.source_size for r in got}:
        own = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in own) - own[0].target) < 0.05 * own[0].target
    again = mixing.taken(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_hashes_that_agree_in_leading_bits(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DIGIT_BITS", 4)
    monkeypatch.setattr(mixing, "LEVELS", 15)
    got = mixing.taken(spark.createDataFrame(ROWS[:60], SCHEMA)).collect()
    assert sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got), key=str) == brute(ROWS[:60])


def test_empty_table_and_clashing_columns(spark):
    assert mixing.taken(spark.createDataFrame([], SCHEMA)).count() == 0
    extra = spark.createDataFrame([(1, "a b", "s", 3, 4)], SCHEMA + ", size int, target int")
    assert mixing.mixed(extra).collect() == extra.collect()
    with pytest.raises(ValueError):
        mixing.mixed(extra.withColumnRenamed("size", "_mix_size"))
