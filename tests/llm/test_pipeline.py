"""Every stage of the pipeline on what its predecessor kept, against brute force."""

from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from rampline.llm import packing
from rampline.llm.common import table, written
from tests.llm.test_lines import brute as plain_lines
from tests.llm.test_mixing import brute as plain_mix
from tests.llm.test_quality import brute as plain_quality
from tests.llm.test_simhash import brute as plain_groups

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def outputs(spark):
    docs = table(spark, SF_DIR, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(written(stage(spark, found[-1], SF_DIR), f"test-{name}"))
    return found


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_columns(outputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "source_mix", "pack"]
    assert all(df.schema == outputs[0].schema for df in outputs[1:-1])


def test_quality_rules(outputs):
    want = {d for d, text, _ in rows_of(outputs[0]) if plain_quality(d, text)[-1]}
    assert {d for d, _, _ in rows_of(outputs[1])} == want


def test_line_dedup(outputs):
    want = {d: text for d, _, _, text in plain_lines(rows_of(outputs[1]))}
    got = outputs[2].collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_simhash_dedup(outputs):
    before, after = rows_of(outputs[2]), rows_of(outputs[3])
    assert sorted(after) == sorted({row for row in before if row[0] in {d for d, _, c in plain_groups(before) if d == c}})
    # of equal texts the first document stays, if its group has no earlier one
    texts = [" ".join((text or "").lower().split()) for _, text, _ in after]
    assert max(Counter(texts).values()) == 1


def test_source_mix(outputs):
    want, got = defaultdict(int), defaultdict(int)
    for d, _, _, _, n in plain_mix(rows_of(outputs[3])):
        want[d] += n
    for d, text, _ in rows_of(outputs[4]):
        got[d] += len((text or "").split())
    assert {d: n for d, n in got.items() if n} == {d: n for d, n in want.items() if n}


def test_pack(outputs):
    encode = packing._encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want, got = Counter(), Counter()
    for d, text, _ in rows_of(outputs[4]):
        want.update((d, i) for i in [*encode(text or ""), 0])
    for piece in outputs[5].collect():
        got.update((piece.doc_id, int(i)) for i in np.frombuffer(piece.ids, "<u4"))
    assert got == want


def test_run(spark, outputs):
    columns = [c for c in outputs[5].columns if c not in ("sequence_id", "offset")]
    assert corpus_pipeline.run(spark, SF_DIR).agg({"length": "sum"}).first() == outputs[5].agg({"length": "sum"}).first()
    assert set(columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"}
