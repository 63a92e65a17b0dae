import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import pyspark.sql.functions as F

from rampline.llm import phrases

SCHEMA = "doc_id long, text string"


def brute(spark, rows):
    """The words left of each row: a row counts as later if its id, then its text hash is larger."""
    texts = spark.createDataFrame(list(set(rows)), SCHEMA).select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    docs = sorted(((2**63 - 1 if r.doc_id is None else r.doc_id, r.h, r.doc_id, r.text) for r in texts), key=lambda r: r[:2])
    # an identical phrase elsewhere in equal rows is the same phrase
    seen, left = set(), {}
    for *_, doc, text in docs:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - 19):
            phrase = tuple(words[i : i + 20])
            if phrase in seen:
                gone.update(range(i, i + 20))
            seen.add(phrase)
        left[doc, text] = (len(words), len(gone), hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())
    return Counter((doc, *left[doc, text]) for doc, text in rows)


def prose(rnd, n, kinds=400):
    return [f"w{rnd.randrange(kinds)}" for _ in range(n)]


def planted(seed=0):
    rnd = random.Random(seed)
    docs = [prose(rnd, rnd.randrange(120)) for _ in range(160)]
    passages = [prose(rnd, n) for n in (19, 20, 21, 27, 28, 29, 45, 80, 150)]
    for doc in docs[20:]:
        for _ in range(rnd.randrange(3)):
            at, passage = rnd.randrange(len(doc) + 1), rnd.choice(passages)
            part = passage[rnd.randrange(3) :] if rnd.random() < 0.3 else passage
            doc[at:at] = part
    docs += [list(docs[30]), docs[31] + prose(rnd, 5), prose(rnd, 4) + docs[32], docs[33][: len(docs[33]) // 2]]
    ids = rnd.sample(range(1000), len(docs))
    return [(i, rnd.choice([" ", "\n", " \t"]).join(doc)) for i, doc in zip(ids, docs, strict=True)]


def checked(spark, rows, **bounds):
    got = phrases.removed(spark.createDataFrame(rows, SCHEMA).repartition(3), **bounds)
    found = got.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)).collect()
    want = brute(spark, rows)
    assert Counter(map(tuple, found)) == want
    return want


@pytest.mark.parametrize(("block_bytes", "hot", "at_once"), [(4_000_000, 2000, 60_000), (3000, 2000, 1), (2000, 3, 100)])
def test_against_brute_force(spark, block_bytes, hot, at_once):
    want = checked(spark, planted(), block_bytes=block_bytes, hot=hot, at_once=at_once)
    assert sum(row[2] > 0 for row in want) > 60


EDGES = [
    (1, None), (2, ""), (3, " \n "), (None, None), (4, "lol " * 200), (5, "a b c " * 40), (6, "lol " * 25),
    (9, "x " + "same words again and again " * 30), (8, "same words again and again " * 30), (8, "same words again and again " * 30),
    (8, "other text of this id " + "same words again and again " * 5), (None, "lol " * 30), (None, "lol " * 30),
    (10, " ".join(f"Ü{i}😀" for i in range(30))), (11, " ".join(f"Ü{i}😀" for i in range(30))),
    (12, " ".join(f"ü{i}😀" for i in range(30))), (-5, " ".join(f"long{i}" for i in range(30_000))),
    (13, " ".join(f"long{i}" for i in range(29_000, 31_000))), (14, " ".join(f"long{i}" for i in range(19))),
    (15, "y" * 50_000 + " " + " ".join(f"long{i}" for i in range(5, 40))),
]


@pytest.mark.parametrize("bounds", [{}, {"block_bytes": 20_000, "hot": 2, "at_once": 10}])
def test_edge_cases(spark, bounds):
    checked(spark, EDGES, **bounds)


def test_a_passage_in_most_documents(spark):
    rnd = random.Random(7)
    passage = prose(rnd, 40)
    rows = [(i, " ".join([*prose(rnd, 15), *passage, *prose(rnd, 15)])) for i in range(300)]
    want = checked(spark, rows, block_bytes=8000, hot=20)
    # a word beside the passage may happen to be the same in two documents
    assert sum(n >= 40 for _, _, n, _ in want) == 299


def test_automaton_finds_overlapping_phrases():
    texts = [b"a " * 25, b"b " + b"a " * 20]
    weights = phrases.np.array([1, 1])
    phrase, text, place = phrases.located([t.strip() for t in texts], weights)
    assert sorted(zip(phrase.tolist(), text.tolist(), place.tolist(), strict=True)) == [(0, 0, k) for k in range(6)] + [(0, 1, 1)]


def test_empty_table_and_clashing_columns(spark):
    assert phrases.digests(spark.createDataFrame([], SCHEMA)).count() == 0
    extra = spark.createDataFrame([(1, "a b", 5, "k", 1)], SCHEMA + ", block int, key string, doc int")
    assert [tuple(r)[:3] for r in phrases.digests(extra).collect()] == [(1, 2, 0)]


@pytest.mark.parametrize("compiled_at_once", [1, 3, 1_000])
def test_automata_of_some_cores_find_all(monkeypatch, compiled_at_once):
    random = np.random.default_rng(8)
    sizes, contents, cores = [], [], []
    for core in range(12):
        shared = [b"%d-%d" % (core, w) for w in range(30)]
        for _ in range(1 if core == 5 else int(random.integers(2, 6))):
            begin = int(random.integers(0, 11))
            contents.append(b" ".join(shared[begin : begin + 20 + int(random.integers(0, 30 - begin - 19))]))
            cores.append(core * 7)
    plain = phrases.compiled
    monkeypatch.setattr(phrases, "compiled", lambda found: plain(sizes.append(len(own := list(found))) or own))
    weights = np.ones(len(contents), np.int64)
    number, text, offset = phrases.located(contents, weights, np.array(cores), compiled_at_once)
    places = {}
    for k, content in enumerate(contents):
        words = content.split()
        for at in range(len(words) - phrases.LENGTH + 1):
            places.setdefault(tuple(words[at : at + phrases.LENGTH]), []).append((k, at))
    want = sorted(sorted(found) for found in places.values() if len(found) > 1)
    got = {}
    for p, k, at in zip(number.tolist(), text.tolist(), offset.tolist()):
        got.setdefault(p, []).append((k, at))
    assert sorted(map(sorted, got.values())) == want
    assert sum(sizes) == len(want)
    assert len(sizes) > 3 if compiled_at_once < 1_000 else len(sizes) == 1
