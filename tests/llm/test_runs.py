import hashlib
import random
import zlib

import numpy as np
import pytest

from rampline.llm import runs

SCHEMA = "doc_id long, text string"


def brute(words, least, exponent):
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                best.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted(((start, length, q) for (start, length), q in best.items()), key=lambda r: (r[0], r[2]))


def some_words(seed):
    rnd = random.Random(seed)
    n, kinds = rnd.randint(0, 80), rnd.choice([1, 2, 2, 3, 9])
    words = [rnd.randrange(kinds) for _ in range(n)]
    if n > 6 and rnd.random() < 0.6:
        a = rnd.randrange(n)
        p = 1 + rnd.randrange(max(1, (n - a) // 2))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize(("least", "exponent"), [(24, 3), (2, 2), (6, 3), (10, 2)])
def test_runs_are_those_of_brute_force(least, exponent):
    for seed in range(400):
        words = some_words(seed)
        assert list(map(tuple, runs.runs_in(np.array(words, np.int64), least, exponent))) == brute(words, least, exponent)


def test_documents_side_by_side_do_not_mix():
    many = [some_words(seed) for seed in range(300)]
    found = runs._runs_of_many([np.array(words, np.int64) for words in many], 12, 3)
    assert [list(map(tuple, own)) for own in found] == [brute(words, 12, 3) for words in many]


def test_ranks_and_agreement():
    for seed in range(100):
        words = some_words(seed) or [0]
        ranks = runs.doubled_ranks(np.array(words, np.int64))
        order = sorted(range(len(words)), key=lambda i: words[i:])
        assert [ranks[-1][i] for i in order] == list(range(len(words)))
        pairs = np.array([(a, b) for a in range(len(words)) for b in range(a + 1, len(words))], np.int64).reshape(-1, 2)
        ahead, back = runs.agreement(ranks, *pairs.T), runs.agreement_before(ranks, *pairs.T)
        for (a, b), right, left in zip(pairs, ahead, back, strict=True):
            assert words[a : a + right] == words[b : b + right] and words[a + right : a + right + 1] != words[b + right : b + right + 1]
            assert words[a - left : a] == words[b - left : b] and (a == left or words[a - left - 1] != words[b - left - 1])


def test_no_run_escapes_the_test_for_repeats():
    # the shortest repeat is reached, and no shorter one would do
    assert runs.shortest_repeat(24, 3) == 16
    words = np.array([*range(8)] * 3, np.int64)
    assert len(runs.repeats_of(words, 16)) and len(brute(words.tolist(), 24, 3)) == 1
    assert not len(runs.repeats_of(words[:-1], 16))


def looped(doc, words):
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def expected(doc, text):
    words = looped(doc, (text or "").encode().split())
    found = brute(words, 24, 3)
    most = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    lines = "".join(f"{start},{length},{q}\n" for start, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = (*most, 1000 * most[1] // most[2]) if most else (None,) * 4
    return (doc, len(found), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def key(row):
    return tuple((value is not None, value or 0) if not isinstance(value, str) else (True, value) for value in row)


def test_query_against_brute_force(spark):
    rnd = random.Random(3)
    prose = [" ".join(f"w{rnd.randrange(200)}" for _ in range(rnd.randrange(400))) for _ in range(120)]
    rows = [(doc, text) for doc, text in enumerate(prose)]
    rows += [
        (500, None), (501, ""), (502, " \n\t "), (None, "lol " * 60), (503, "lol\n" * 500), (504, "a b " * 11 + "a"),
        (505, "x " * 24), (506, "x " * 23), (505, "x " * 24), (507, "ü 😀 é " * 20), (-9, "a b c " * 30 + "a b d " * 40),
        (508, "a a b " * 30 + "c " + "a a b " * 30), (509, "one\vtwo\fthree\rfour " * 9), (510, "x" * 200_000 + " y" * 3000),
        (511, None), (519, "q r " * 9), (528, ""),
    ]
    got = runs.digests(runs.looped(spark.createDataFrame(rows, SCHEMA)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [expected(*row) for row in rows]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert sum(w[1] > 0 for w in want) > 10


def test_real_outputs(spark):
    text = "start " + "tic tac toe " * 9 + "end"
    row = runs.collapsed(spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert row.n_words == 29 and [tuple(r) for r in row.runs] == [(1, 27, 3)] and row.collapsed == "start tic tac toe end"


def test_few_words_at_once(spark, monkeypatch):
    monkeypatch.setattr(runs, "TESTS_AT_ONCE", 7)
    words = np.array([0, 1, 0, 1, 0, 1, 1, 1, 1, 1, 0, 0, 0, 1, 0, 0, 0, 1, 0, 0, 0, 1], np.int64)
    assert list(map(tuple, runs.runs_in(words, 4, 2))) == brute(words.tolist(), 4, 2)


def test_empty_table_and_clashing_columns(spark):
    assert runs.digests(runs.looped(spark.createDataFrame([], SCHEMA))).count() == 0
    extra = spark.createDataFrame([(1, "a b", 5, "k", 1)], SCHEMA + ", n_words int, runs string, most int")
    assert [tuple(r)[:2] for r in runs.digests(runs.looped(extra)).collect()] == [(1, 0)]
