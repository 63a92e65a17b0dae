import hashlib

import numpy as np
import pytest

from rampline.llm import lines

SCHEMA = "doc_id long, text string, source string"
LONG = "a line that is long enough to be shared"

ROWS = [
    (4, f"first\n{LONG}\nlast", "a"),
    (2, f"  {LONG.upper()}\t\nshort\n{LONG}", "a"),
    (2, f"  {LONG.upper()}\t\nshort\n{LONG}", "a"),
    (9, f"{LONG}\n{LONG}\nélan vital ÉTÉ\n", None),
    (10, "ÉLAN VITAL ÉTÉ\nélan vital ÉTÉ\nonly here and nowhere else", "b"),
    (11, None, "a"),
    (12, "", "a"),
    (13, "\n\n", "a"),
    (None, f"{LONG}\nof no document by name", "a"),
    (None, "of no document by name\nnine char\nnine char", "a"),
    (14, "nine char\nten chars.", "a"),
    (15, "nine char\nTen Chars.\r", "a"),
    (16, "\n".join(f"a numbered line {i}" for i in range(3000)), "a"),
    (17, "\n".join(f"a numbered line {i}" for i in range(0, 6000, 2)), "a"),
]


def brute(rows):
    blanks = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    name = lambda d: float("inf") if d is None else d
    holders = {}
    for doc, text, _ in rows:
        for line in (text or "").split("\n"):
            key = line.strip(blanks).translate(lower)
            if len(key) >= 10:
                holders.setdefault(key, set()).add(name(doc))
    out = []
    for doc, text, _ in rows:
        own, kept = (text or "").split("\n"), []
        for line in own:
            docs = holders.get(line.strip(blanks).translate(lower), set())
            if len(docs) < 2 or min(docs) == name(doc):
                kept.append(line)
        out.append((doc, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def test_digests(spark):
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(ROWS)]
    got = lines.digests(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("limits", [(100_000, 1_000_000), (50, 20)])
def test_texts(spark, monkeypatch, limits):
    monkeypatch.setattr(lines, "KEYS_PER_SHARD", limits[0])
    monkeypatch.setattr(lines, "PROBES_PER_TASK", limits[1])
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = lines.deduplicated(docs)
    assert got.columns == docs.columns
    want = [(d, None if d == 11 else t) for d, _, _, t in brute(ROWS)]
    assert sorted(got.select("doc_id", "text").collect(), key=str) == sorted(want, key=str)


def test_empty_table_and_clashing_columns(spark):
    assert lines.digests(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, LONG, 7, "x"), (2, LONG, 8, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, high long, shard string")
    assert sorted(lines.deduplicated(docs).collect()) == [(1, LONG, 7, "x"), (2, "", 8, "y")]
    with pytest.raises(ValueError):
        lines.deduplicated(docs.withColumnRenamed("high", "_line_gone"))


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_hash_is_minimal_and_perfect(n):
    random = np.random.default_rng(n)
    keys = random.integers(0, 1 << 63, (2 * n, 2), dtype=np.uint64)
    high, low = keys[:n, 0].copy(), keys[:n, 1].copy()
    sizes, bits = lines.build_hash(high, low)
    blank = {"fingerprints": b"", "counts": b"", "owners": b""}
    index = lines.LineIndex({"sizes": sizes.tobytes(), "bits": bits.tobytes(), **blank})
    assert sorted(index.numbers(high, low).tolist()) == list(range(n))
    assert len(bits) * 64 <= 8 * n + 64 * len(sizes)
    # keys that are not in the set are told apart by their fingerprints
    index.fingerprints = np.empty(n, np.uint64)
    index.fingerprints[index.numbers(high, low)] = low
    index.owners = np.arange(n)
    assert (index.owner_of(keys[n:, 0], keys[n:, 1]) == lines.NO_ID).all()
    assert (index.owner_of(high, low) != lines.NO_ID).all()
