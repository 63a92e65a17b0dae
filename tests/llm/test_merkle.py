import hashlib
import zlib
from collections import Counter

from rampline.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def hashed(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return hashed(*map(field, row))


def tree(nodes):
    """Root of a list of digests, and per node the siblings before and after it on each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k - k % 8 : k - k % 8 + 8]
            paths[i].append(("".join(run[: k % 8]), "".join(run[k % 8 + 1 :])))
        nodes = [hashed(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        at = [k // 8 for k in at]
    return nodes[0], paths


def lowered(row):
    if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 3:
        return row
    return (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))


def brute(rows):
    lines = {}
    for row in rows:
        lines.setdefault("" if row[2] is None else "=" + row[2], []).append(row)
    for line in lines.values():
        line.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    names = sorted(lines, key=str.encode)
    trees = [tree([leaf(r) for r in lines[name]]) for name in names]
    root, upper = tree([top for top, _ in trees])
    found = []
    for name, (top, paths), above in zip(names, trees, upper, strict=True):
        for row, path in zip(lines[name], paths, strict=True):
            held = leaf(lowered(row))
            for before, after in path + above:
                held = hashed(before, held, after)
            proof = hashed(*(before + after for before, after in path + above))
            found.append((row[0], leaf(row), top, root, proof, held, held == root))
    return found


def checked(spark, rows, schema=SCHEMA):
    got = merkle.proofs(spark.createDataFrame(rows, schema), merkle.tampered_text()).collect()
    want = brute([row[:5] for row in rows])
    assert Counter(map(tuple, got)) == Counter(want)
    return want


def test_trees_of_many_sizes(spark):
    sizes = {"en": 700, "de": 64, "fr": 65, "es": 8, "it": 9, "nl": 1, "": 2, "日本": 3, "zz": 513}
    rows, doc = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((doc * 7, f"s{doc % 3}", lang, doc, f"Text {doc} WITH Capitals"))
            doc += 1
    want = checked(spark, rows[::-1])
    assert {w[-1] for w in want} == {True, False}


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, None, None, None, None), (2, "", "", 0, ""), (None, "s", "en", 3, "No ID"), (None, "s", "en", 3, "No ID"),
        (None, None, None, None, None), (5, "s", "en", 1, "Same Row")] + [(5, "s", "en", 1, "Same Row")] * 12 + [
        (5, "s", "en", 1, "Other row of THIS id"), (6, "s", "en", 4, "Ünï 😀 ABC"), (7, "s", "en", 9, "X" * 300_000),
        (-3, "s", "en", -9, "negative ID"), (8, "3:abc", "en", 1, "-"), (9, "-", "-", 1, "1:a"),
    ]
    checked(spark, rows)


def test_a_line_with_one_row_and_a_lone_row(spark):
    checked(spark, [(0, "s", "en", 1, "alone, ALONE")])
    checked(spark, [(k, "s", f"l{k}", 1, f"One of {k}") for k in range(70)])


def test_one_language_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 64)
    checked(spark, [(k, "s", "en", 1, f"Row {k}") for k in range(1100)])


def test_every_field_counts(spark):
    row = dict(zip(merkle.FIELDS, (4, "s", "en", 1, "a b"), strict=True))
    changes = ({}, {"doc_id": 5}, {"source": "t"}, {"lang": "de"}, {"n_chars": 2}, {"text": "a B"}, {"text": None})
    rows = spark.createDataFrame([tuple((row | change).values()) for change in changes], SCHEMA)
    leaves = rows.select(merkle.leaf_of({name: rows[name] for name in merkle.FIELDS}).alias("leaf")).distinct()
    assert leaves.count() == len(changes)


def test_untampered_rows_verify(spark):
    rows = [(k, "s", "en", 1, f"Row {k}") for k in range(30)]
    assert merkle.manifest(spark.createDataFrame(rows, SCHEMA)).where("not verified").count() == 0


def test_empty_table_and_clashing_columns(spark):
    assert merkle.proofs(spark.createDataFrame([], SCHEMA)).count() == 0
    names = "line string, node string, pos long, n long, tie int, place int, share int, path string, claim string, `of` int"
    rows = [(k, "s", "en", 1, f"Row {k}", "x", "y", 1, 2, 3, 4, 5, "p", "c", 6) for k in range(20)]
    checked(spark, rows, f"{SCHEMA}, {names}")
