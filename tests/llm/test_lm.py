import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rampline.llm import lm

SCHEMA = "doc_id long, text string"
LANGUAGES = ("red green blue white black".split(), "un deux trois quatre cinq six".split(), "ja nein oder und aber".split())


def corpus(n=240):
    random = np.random.default_rng(3)
    rows = []
    for i in range(n):
        words = [str(w) for w in random.choice(LANGUAGES[i % 3], 40)]
        words[5] = f"rare{i}"
        rows.append((i, " ".join(words)))
    return rows + [(n, None), (n + 1, ""), (None, "Red GREEN\tblue\n"), (n + 2, "und " * 3000), (0, rows[0][1])]


def counts_of(rows):
    learned = [t for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1]
    return Counter(w for t in learned for w in [*lm.tokens_of(t), lm.END])


def base(text, counts):
    n, v = sum(counts.values()), len(counts)
    return sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*lm.tokens_of(text), lm.END])


@pytest.mark.parametrize("limits", [(8191, 200_000), (9, 12)])
def test_scored(spark, monkeypatch, limits):
    monkeypatch.setattr(lm, "MODEL_WORDS", limits[0])
    monkeypatch.setattr(lm, "LOOKUP_WORDS", limits[1])
    rows = corpus()
    counts = counts_of(rows)
    got = lm.scored(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    texts = {d: t for d, t in rows}
    for r in got:
        tokens = [*lm.tokens_of(texts[r.doc_id]), lm.END]
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known) == (len(tokens), sum(counts[w] > 0 for w in tokens))
        assert r.train_tokens == sum(counts.values())
        assert r.base_score == pytest.approx(base(texts[r.doc_id], counts), abs=1e-6)
        assert r.score < 0
    held = [r for r in got if r.held_out]
    if limits[0] > 100:
        assert sum(r.score for r in held) > 0.85 * sum(r.base_score for r in held)


def test_rounds_follow_the_corpus(spark, monkeypatch):
    assert [lm.rounds_for(n) for n in (0, 1, 49_999_999, 50_000_000, 100_000_000, 8_000_000_000)] == [2, 2, 2, 2, 3, 9]
    monkeypatch.setattr(lm, "TOKENS_OF_TWO_ROUNDS", 1_000)
    rows = corpus()
    assert lm.rounds_for(sum(counts_of(rows).values())) > 4
    held = [r for r in lm.scored(spark.createDataFrame(rows, SCHEMA)).collect() if r.held_out]
    assert sum(r.score for r in held) > 0.85 * sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    counts = np.array([50, 30, 20, 9, 5, 2, 0], float)
    shape = lm.shape_of(counts, 14.0)
    flat = lm.initial(shape) + np.random.default_rng(0).normal(0, 0.2, len(lm.initial(shape))).astype(np.float32)
    # seven words of the model, six of them seen, and four others, seen 14 times together
    n_distinct = 6 + 4
    scorer = lm.Scorer(flat, shape, 0, counts.sum() + 14, n_distinct)
    before = np.array([3, 1, 7], np.int64)
    alone = scorer.score([before])[0]
    total = sum(10 ** (scorer.score([np.append(before, w)])[0] - alone) for w in range(7))
    other = 10 ** (scorer.score([np.append(before, 7)])[0] - alone)
    # the factor of other words is their count and a half; an unseen one has a half
    assert total + other * (14 + 0.5 * 4 + 0.5) == pytest.approx(1, abs=0.05)


def test_state_is_carried_over_windows(monkeypatch):
    shape = lm.shape_of(np.array([9.0, 5, 4, 3, 2]), 3.0)
    flat = lm.initial(shape) + np.random.default_rng(1).normal(0, 0.3, len(lm.initial(shape))).astype(np.float32)
    docs = [np.append(np.random.default_rng(i).integers(1, 6, n), 0) for i, n in enumerate((90, 3, 0, 41, 17))]
    scorer = lm.Scorer(flat, shape, 0, 26, 6)
    each = [scorer.score([doc])[0] for doc in docs]
    together = scorer.score(docs)
    monkeypatch.setattr(lm, "WINDOW", 7)
    monkeypatch.setattr(lm, "STREAMS", 2)
    assert together == pytest.approx(each, abs=1e-4)
    assert scorer.score(docs) == pytest.approx(each, abs=1e-4)


def test_gradient():
    shape = lm.shape_of(np.array([9.0, 5, 4, 3, 2]), 3.0)
    random = np.random.default_rng(2)
    flat = (lm.initial(shape) + random.normal(0, 0.3, len(lm.initial(shape)))).astype(np.float64)
    words, aim = random.integers(0, 6, (2, 6, 3))
    fresh, state = words == 0, random.normal(size=(lm.HIDDEN, 3))

    def loss(flat):
        states = lm._rows(lm._run(lm.views(flat, shape), words, fresh, state))
        chance = lm.probabilities(lm.views(flat, shape), shape, shape.class_of(), states, aim.ravel())
        return -np.log(chance).sum() / (lm.STREAMS * lm.WINDOW)

    g, _ = lm.gradient(lm.views(flat, shape), shape, shape.class_of(), words, aim, fresh, state)
    whole = np.concatenate([v.ravel() for v in g.values()])
    for at in random.choice(np.flatnonzero(whole), 60):
        step = np.zeros_like(flat)
        step[at] = 1e-2
        # states are kept in single precision
        assert (loss(flat + step) - loss(flat - step)) / 2e-2 == pytest.approx(whole[at], rel=0.03, abs=2e-7)


def test_empty_tables(spark):
    assert lm.scored(spark.createDataFrame([], SCHEMA)).count() == 0
    held = [d for d in range(200) if zlib.crc32(str(d).encode()) % 5 == 1][:3]
    got = lm.scored(spark.createDataFrame([(d, "a b") for d in held], SCHEMA + "").withColumnRenamed("x", "y")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)] * 3


def test_words_are_cut_without_python_objects():
    texts = ["A b\x0bc  d", None, "", " \n", "äÖ B\tb A zz zz", "x\x00y \x1cz", "É"]
    words, sizes = lm.all_words(pa.array(texts))
    assert words.to_pylist() == [w for text in texts for w in lm.tokens_of(text)]
    assert sizes.tolist() == [len(lm.tokens_of(text)) for text in texts]
    assert lm.all_words(pa.array([], pa.string()))[1].tolist() == []


def test_pieces_are_all_rows(monkeypatch):
    monkeypatch.setattr(lm, "BYTES_AT_ONCE", 5)
    batch = pa.RecordBatch.from_pydict({"text": ["abc", "de", "f", None, "a text beyond the limit", "", "ghij"]})
    pieces = list(lm._pieces(batch))
    assert [text for piece in pieces for text in piece["text"].to_pylist()] == batch["text"].to_pylist()
    assert len(pieces) > 2
    assert all(piece.num_rows == 1 or sum(len(t or "") for t in piece["text"].to_pylist()) <= 5 for piece in pieces)


@pytest.mark.parametrize("spread", [1, 400])
def test_scores_far_apart_keep_their_softmax(spread):
    shape = lm.shape_of(np.array([9.0, 5, 4, 3, 2, 2, 2, 1]), 3.0)
    flat = lm.initial(shape) + np.random.default_rng(4).normal(0, 0.3, len(lm.initial(shape))).astype(np.float32)
    p = lm.views(flat, shape)
    p["to_class"] *= spread
    p["to_word"] *= spread
    assert all(lm.biases(p, shape, 1.0).words_serve) == (spread == 1)
    random = np.random.default_rng(5)
    states, targets = np.tanh(random.normal(size=(50, lm.HIDDEN))).astype(np.float32), random.integers(0, 9, 50)

    def softmax(x):
        x = np.exp(x - x.max(1, keepdims=True))
        return x / x.sum(1, keepdims=True)

    kind = shape.class_of()[targets]
    want = softmax(states.astype(float) @ p["to_class"] + p["class_bias"])[np.arange(50), kind]
    for row, (target, c) in enumerate(zip(targets, kind)):
        if c < len(shape.starts) - 1:
            begin, end = shape.starts[c], shape.starts[c + 1]
            want[row] *= softmax(states[row : row + 1].astype(float) @ p["to_word"][begin:end].T + p["word_bias"][begin:end])[0, target - begin]
    assert lm.probabilities(p, shape, shape.class_of(), states, targets) == pytest.approx(want, rel=1e-3, abs=1e-30)


def test_a_learner_makes_its_large_arrays_once():
    shape = lm.shape_of(np.array([9.0, 5, 4, 3, 2]), 3.0)
    learner = lm.Learner(lm.initial(shape), shape)
    stream = np.append(np.random.default_rng(6).integers(1, 6, 4 * lm.STREAMS * lm.WINDOW - 1), 0)
    learner.learn(stream, 0)
    held = {name: id(own) for name, own in learner.space.held.items()}
    learner.learn(stream, 0)
    assert {name: id(own) for name, own in learner.space.held.items()} == held


def test_small_batches_are_scored_together():
    class Counted:
        def __init__(self):
            self.calls = []

        def score(self, docs):
            self.calls.append(len(docs))
            return np.array([float(doc.sum()) for doc in docs])

    def batches(sizes):
        n = 0
        for size in sizes:
            ids = [np.full(3, n + i, "<u2").tobytes() for i in range(size)]
            yield pa.RecordBatch.from_pydict({"row": list(range(n, n + size)), "ids": pa.array(ids, pa.binary())})
            n += size

    for most, calls in ((1_000_000, [17]), (12, [4, 4, 4, 4, 1])):
        scorer = Counted()
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(lm, "TOKENS_SCORED_AT_ONCE", most)
            got = [(row, score) for b in lm._score(scorer)(batches([10, 1, 0, 6])) for row, score in zip(*b.to_pydict().values())]
        assert got == [(row, 3.0 * row) for row in range(17)]
        assert scorer.calls == calls


def test_a_word_of_a_window_enters_the_gates_once(monkeypatch):
    """However often a window holds a word, its inputs are computed once."""
    shape = lm.shape_of(np.array([9.0, 5, 4, 3, 2]), 3.0)
    flat = lm.initial(shape) + np.random.default_rng(8).normal(0, 0.3, len(lm.initial(shape))).astype(np.float32)
    p, made = lm.views(flat, shape), []
    inputs_of = lm.inputs_of
    monkeypatch.setattr(lm, "inputs_of", lambda p, words: made.append(words) or inputs_of(p, words))
    words = np.random.default_rng(9).choice([0, 2, 5], (7, 40))
    state = np.zeros((lm.HIDDEN, 40), np.float32)
    states = lm._run(p, words, words == 0, state).copy()
    assert [list(own) for own in made] == [[0, 2, 5]]
    # plain formulas
    want, h = np.zeros((40, lm.HIDDEN)), lm.HIDDEN
    for t in range(7):
        want = want * (words[t] != 0)[:, None]
        given, carried = p["embed"][words[t]] @ p["input"] + p["gates"], want @ p["state"]
        update, reset = ((1 + np.tanh((given + carried)[:, s : s + h])) / 2 for s in (0, h))
        new = np.tanh(given[:, 2 * h :] + reset * carried[:, 2 * h :])
        want = new + update * (want - new)
        assert states[t] == pytest.approx(want, abs=1e-5)


def test_products_in_pieces(monkeypatch):
    random = np.random.default_rng(10)
    rows, weights, others = (random.normal(size=size).astype(np.float32) for size in ((53, 4), (4, 6), (53, 6)))
    for most in (1, 24 * 10, 1_000_000):
        monkeypatch.setattr(lm, "MULTIPLIED_AT_ONCE", most)
        assert lm._product(rows, weights, np.empty((53, 6), np.float32)) == pytest.approx(rows @ weights, abs=1e-5)
        assert lm._summed(rows, others) == pytest.approx(rows.T @ others, abs=1e-4)


@pytest.mark.parametrize("spread", [1, 400])
def test_gradients_with_and_without_factors_agree(spread):
    """Scores far apart take the other way through the softmax, with the same formulas."""
    shape = lm.shape_of(np.array([9.0, 5, 4, 3, 2, 2, 2, 1]), 3.0)
    flat = lm.initial(shape) + np.random.default_rng(11).normal(0, 0.3, len(lm.initial(shape))).astype(np.float32)
    p, random = lm.views(flat, shape), np.random.default_rng(12)
    p["to_class"] *= spread
    p["to_word"] *= spread
    words, targets = random.integers(0, 9, (2, 5, 30))
    state = np.zeros((lm.HIDDEN, 30), np.float32)
    g, _ = lm.gradient(p, shape, shape.class_of(), words, targets, words == 0, state)
    states = lm._rows(lm._run(p, words, words == 0, state)).astype(float)
    scores = states @ p["to_class"] + p["class_bias"]
    share = np.exp(scores - scores.max(1, keepdims=True))
    share /= share.sum(1, keepdims=True)
    share[np.arange(len(share)), shape.class_of()[targets.ravel()]] -= 1
    share /= lm.STREAMS * lm.WINDOW
    assert g["to_class"] == pytest.approx(states.T @ share, rel=1e-3, abs=1e-7)
    assert g["class_bias"] == pytest.approx(share.sum(0), rel=1e-3, abs=1e-7)
