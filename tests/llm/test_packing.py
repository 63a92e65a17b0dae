import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rampline.llm import packing

SCHEMA = "doc_id long, text string"
JSON = public_tokenizers.path("byte_bpe_50k.json")

ROWS = [(i, f"document number {i} says " + "some words again " * (i % 37)) for i in range(200)] + [
    (900, None), (901, ""), (902, "long " * 40_000), (903, "Ünï cødé \U0001f600\n\n\t  x"), (None, "no id"),
    (904, "a copy"), (905, "a copy"), (904, "a copy"),
]


@cache
def tokenizer():
    return Tokenizer.from_file(JSON)


def encoded(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("size", [1024, 64])
def test_every_id_lies_in_one_piece(spark, size):
    rows = ROWS
    pieces = packing.packed(spark.createDataFrame(rows, SCHEMA), JSON, size).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and zlib.crc32(ids.astype("<u4").tobytes()) == p.ids_crc32
        by_doc[p.doc_id].append((p.start, ids.tolist(), p.doc_tokens))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    want = defaultdict(list)
    for doc, text in rows:
        want[doc].append(encoded(text))
    assert set(by_doc) == set(want)
    for doc, copies in want.items():
        if len(copies) == 1:
            found = sorted(by_doc[doc])
            assert sum((ids for _, ids, _ in found), []) == copies[0]
            assert [start for start, _, _ in found] == np.cumsum([0, *[len(i) for _, i, _ in found[:-1]]]).tolist()
            assert {total for _, _, total in found} == {len(copies[0])}
        else:
            assert sum(len(ids) for _, ids, _ in by_doc[doc]) == sum(map(len, copies))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == size or at.bit_count() == 1 and at < size


ADDED = [token.content for token in tokenizer().get_added_tokens_decoder().values()]


def test_ids_are_those_of_the_file():
    assert ADDED
    random = np.random.default_rng(2)
    letters = list("aB3 \n\t.,'’éß😀漢\u00a0\u200b<|>_") + ["n't", "  ", "endoftext", "the", " of"]
    texts = ["".join(random.choice(letters, random.integers(0, 60))) for _ in range(500)]
    for token in ADDED:
        texts += [token, f"hello {token} x", f"{token}{token}", f"a{token}\n{token} b", token[:-1], f"{token[1:]} {token}", token.upper()]
    for _, text in ROWS:
        texts.append(text or "")
    for text in texts:
        assert list(packing._encoder(JSON)(text)) == encoded(text)[:-1], text


def test_added_tokens_in_documents(spark):
    rows = [(k, f"one {token} two") for k, token in enumerate(ADDED)]
    pieces = packing.packed(spark.createDataFrame(rows, SCHEMA), JSON).collect()
    found = defaultdict(list)
    for p in sorted(pieces, key=lambda p: p.start):
        found[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    assert found == {k: encoded(text) for k, text in rows}


@pytest.mark.parametrize(("dims", "levels"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, levels):
    axes = np.meshgrid(*[np.arange(1 << levels)] * dims, indexing="ij")
    cells = np.stack([a.ravel() for a in axes], 1)
    keys = packing.hilbert_key(cells, levels)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    along = cells[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_alike_documents_have_near_points():
    random = np.random.default_rng(0)
    near, far = [], []
    for _ in range(50):
        ids, other = random.integers(0, 50_000, (2, 300))
        changed = ids.copy()
        changed[:6] = random.integers(0, 50_000, 6)
        near.append(np.abs(packing.point(ids) - packing.point(changed)).sum())
        far.append(np.abs(packing.point(ids) - packing.point(other)).sum())
    assert np.mean(near) < 0.4 * np.mean(far)


def test_empty_table_and_clashing_columns(spark):
    assert packing.packed(spark.createDataFrame([], SCHEMA), JSON).count() == 0
    extra = spark.createDataFrame([(1, "a b", 5, "k")], SCHEMA + ", start int, key string")
    assert [(p.doc_id, p.start) for p in packing.packed(extra, JSON).collect()] == [(1, 0), (1, 2)]
