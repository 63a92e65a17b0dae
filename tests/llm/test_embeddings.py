import numpy as np
import pytest

from rampline.llm import embeddings
from tests.llm.test_simhash import roots

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(seed, n_clusters=12, size=14, dims=16):
    random = np.random.default_rng(seed)
    out = []
    for _ in range(n_clusters):
        centre = random.normal(size=dims)
        for _ in range(size):
            out.append(centre + random.uniform(0.05, 0.45) * random.normal(size=dims))
    return [x.astype(np.float32).tolist() for x in out]


def brute(rows, cosine=0.9):
    unit = []
    for _, v, _ in rows:
        ok = v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)
        x = np.array(v, float) / np.abs(np.array(v, float)).max() if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine
    ]
    root = roots(len(rows), links)
    least = {}
    for (vec, _, _), r in zip(rows, root, strict=True):
        if vec is not None:
            least[r] = min(vec, least.get(r, vec))
    out = []
    for i, (vec, _, _) in enumerate(rows):
        component = least.get(root[i])
        out.append((vec, sum(i in pair for pair in links), component, vec is not None and vec == component))
    return sorted(out, key=str)


def found(spark, rows):
    got = embeddings.linked(spark.createDataFrame(rows, SCHEMA), 0.9)
    return sorted(map(tuple, got.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("block", [4096, 5])
def test_all_links_are_found(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "QUERIES_AT_ONCE", 7)
    rows = [(1000 - i, v, i % 3) for i, v in enumerate(clustered(block))]
    assert found(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 0), (2, [1.0, 0.0, 0.0], 0), (2, [1.0, 0.0, 0.0], 0), (3, [5.0, 0.0, -0.0], 0), (4, None, 0),
        (5, [0.0, 0.0, 0.0], 1), (6, [0.0, 0.0, 0.0], 1), (7, [nan, 1.0, 0.0], 1), (8, [inf, 0.0, 0.0], None), (9, [], 0),
        (10, [None, 1.0, 0.0], 0), (11, [1e-30, 0.0, 0.0], 0), (12, [1e30, 1e29, 0.0], 0), (13, [1.0, 0.0], 0),
        (14, [3.0, 0.1], 0), (15, [0.0, 1.0, 0.0], 0), (None, [0.0, 2.0, 0.1], 0), (None, [0.0, 0.0, 1.0], 0),
        (-4, [-1.0, 0.0, 0.0], 0),
    ]
    assert found(spark, rows) == brute(rows)


def test_copies_of_one_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0], 0) for i in range(500)] + [(500 + i, v, 0) for i, v in enumerate(clustered(9, 4, 10, 4))]
    assert found(spark, rows) == brute(rows)


def test_no_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 0), (None, [0.0], 0)]) == brute([(1, None, 0), (None, [0.0], 0)])
    extra = spark.createDataFrame([(1, [1.0], 5, 6)], "vec_id long, embedding array<float>, rep int, list int")
    assert [tuple(r) for r in embeddings.linked(extra).collect()] == [(1, 0, 1, True)]


def test_recall_against_brute_force(spark):
    """Pairs right at the limit, the hardest to find, among many unrelated vectors."""
    random = np.random.default_rng(11)
    x = random.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = random.normal(size=(1500, 64))
    aside -= (aside * x[:1500]).sum(1, keepdims=True) * x[:1500]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = random.uniform(0.9, 0.93, (1500, 1))
    both = np.concatenate([x, cosine * x[:1500] + np.sqrt(1 - cosine**2) * aside]).astype(np.float32)
    exact = both.astype(float)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    links = (exact @ exact.T >= 0.9).sum(1) - 1
    rows = [(i, v.tolist(), 0) for i, v in enumerate(both)]
    got = {r.vec_id: r.n_links for r in embeddings.linked(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] <= links[i] for i in range(len(both)))
    assert sum(got.values()) >= 0.95 * links.sum()


def test_hot_group_over_many_lists(spark):
    """A half of the vectors near one, at the limit of each other, spread over more lists than a few nearest."""
    random = np.random.default_rng(17)
    centre = random.normal(size=32)
    hot = centre / np.linalg.norm(centre) + 0.33 * random.normal(size=(1500, 32)) / np.sqrt(32)
    both = np.concatenate([hot, random.normal(size=(1500, 32))]).astype(np.float32)
    exact = both.astype(float)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    cosines = exact @ exact.T
    assert (np.abs(cosines - 0.9) > 1e-12).all()
    links = (cosines >= 0.9).sum(1) - 1
    rows = [(i, v.tolist(), 0) for i, v in enumerate(both)]
    got = {r.vec_id: r.n_links for r in embeddings.linked(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(len(both))] == links.tolist()


def test_counts_agree_from_both_ends(spark, monkeypatch):
    """With a depth of nothing, what one end finds counts for both, so the counts stay even in sum."""
    monkeypatch.setattr(embeddings, "probe_depth", lambda *_: 0.0)
    vectors = clustered(23, 40, 20)
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = {r.vec_id: r for r in embeddings.linked(table).collect()}
    assert sum(r.n_links for r in got.values()) % 2 == 0
    exact = np.array(vectors, float)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    links = (exact @ exact.T >= 0.9).sum(1) - 1
    assert all(got[i].n_links <= links[i] for i in range(len(rows)))
    assert sum(r.n_links for r in got.values()) < links.sum()  # it was made to miss some


def test_probes_are_few_and_find_pairs_at_the_limit(spark):
    """More than 226 lists: of 60,000 vectors a few lists each are read, and 0.98 of the planted pairs found."""
    random = np.random.default_rng(31)
    n, planted = 56_000, 4_000
    x = random.normal(size=(n, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = random.normal(size=(planted, 32))
    aside -= (aside * x[:planted]).sum(1, keepdims=True) * x[:planted]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    near = 0.901 * x[:planted] + np.sqrt(1 - 0.901**2) * aside
    both = np.concatenate([x, near])
    quantiser = embeddings.Quantiser(both[random.choice(len(both), 16_384, replace=False)], 244)
    own = embeddings._nearest(both, quantiser.coarse)
    depth = quantiser.random_depth(both[-2048:], 0.9)
    read = quantiser.lists_to_read(both, own, np.full(244, 2.0), depth, embeddings._reach(0.9))
    assert np.mean([len(lists) for lists in read]) < 0.2 * 244
    found = [own[n + i] in read[i] or own[i] in read[n + i] for i in range(planted)]
    assert np.mean(found) >= 0.98


def test_distances_come_in_bounded_blocks():
    assert sum(1 for _ in embeddings._in_blocks(50_000, 4096)) > 50
    rows = [s for s in embeddings._in_blocks(10, 1 << 30)]
    assert len(rows) == 10
    x = np.random.default_rng(1).normal(size=(3000, 8))
    assert (embeddings._nearest(x, x[:1500]) == embeddings._distances(x, x[:1500]).argmin(1)).all()
