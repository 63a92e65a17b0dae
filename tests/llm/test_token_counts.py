import math

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rampline.llm import token_counts
from rampline.llm.token_counts import Vocabulary, terminal_counts

SCHEMA = "doc_id long, text string"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SMALL = Vocabulary(["▁", "a", "▁a", "b", "ab", "ba", "aba", "abab", "▁ab", "bb"])


def brute(word, vocabulary):
    """The best cut by plain recursion."""
    word = "▁" + word

    def best(end):
        if not end:
            return 0.0, 0
        options = [
            (best(begin)[0] + vocabulary.logs[word[begin:end]], -begin, best(begin)[1] + 1)
            for begin in range(end)
            if word[begin:end] in vocabulary.logs
        ]
        if word[end - 1] not in vocabulary.logs:
            n = len(word[end - 1].encode())
            options.append((best(end - 1)[0] + n * vocabulary.byte, -end, best(end - 1)[1] + n))
        score, _, n = max(options)
        return score, n

    score, n = best(len(word))
    return n, score


@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=9), max_size=12))
@settings(max_examples=60, deadline=None)
def test_terminal_counts(words):
    got = terminal_counts(words, SMALL)
    assert set(got) == set(words)
    for word in words:
        n, score = brute(word, SMALL)
        assert math.isclose(got[word][1], score, abs_tol=1e-9)
        assert got[word][0] == n


ROWS = [(1, "the cat and the dog\n"), (2, None), (3, ""), (4, " \t\n"), (None, "the cat ünïcode \U0001f600"), (1, "the cat and the dog\n"), (5, "word " * 20_000)]


@pytest.mark.parametrize("most", [500_000, 2])
def test_counted(spark, monkeypatch, most):
    monkeypatch.setattr(token_counts, "MOST_WORDS", most)
    vocabulary = token_counts.sentencepiece_vocabulary(MODEL)
    want = []
    for doc, text in ROWS:
        words = (text or "").encode().split()
        found = {w: terminal_counts([w.decode()], vocabulary)[w.decode()] for w in set(words)}
        want.append((doc, len(words), sum(found[w][0] for w in words)))
    got = token_counts.counted(spark.createDataFrame(ROWS, SCHEMA), MODEL).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_tokens) for r in got), key=str) == sorted(want, key=str)


def test_empty_table_and_clashing_columns(spark):
    assert token_counts.counted(spark.createDataFrame([], SCHEMA), MODEL).count() == 0
    extra = spark.createDataFrame([(1, "a b", 5)], SCHEMA + ", n_words int")
    assert token_counts.counted(extra, MODEL).first().n_words == 2
