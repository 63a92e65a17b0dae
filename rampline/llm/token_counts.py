"""Token counts of a unigram vocabulary by dynamic programming over a trie.

A word is cut into the pieces whose log probabilities add up to most; the forward score of
a prefix does not depend on what follows it. So the distinct words of a task are walked in
sorted order, which is the depth-first order of their trie: the scores of the prefix that a
word shares with the one before stay on a stack, each node of the trie is computed once, and
the number of pieces is stored where a word ends. Documents then only look words up.

Nothing is shuffled. A task keeps words in memory up to ``MOST_WORDS`` and starts a new trie
beyond that.

The vocabulary is a list of pieces in order of rank, for which log probabilities follow
Zipf's law; characters outside it are cut into their bytes, which come after all pieces.

Edge cases: null and empty texts have no words and no tokens. Long texts are counted whole.
Rows are counted alone, so repeated rows count alike, and an empty table gives an empty
result. Columns other than id and text are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

MOST_WORDS = 500_000
WORD_START = "▁"


class Vocabulary:
    def __init__(self, pieces: list[str]) -> None:
        norm = math.log(sum(1 / (rank + 1) for rank in range(len(pieces) + 256)))
        self.logs = {piece: -math.log(rank + 1) - norm for rank, piece in enumerate(pieces)}
        self.longest = max(map(len, self.logs), default=1)
        self.byte = -math.log(len(pieces) + 256) - norm


@cache
def sentencepiece_vocabulary(path: str) -> Vocabulary:
    """The ordinary pieces of a sentencepiece model, in order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return Vocabulary(
        [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    )


def terminal_counts(words: list[str], vocabulary: Vocabulary) -> dict[str, tuple[int, float]]:
    """The number of pieces and the score of each word.

    Among equal scores the longer last piece wins.
    """
    logs, longest, byte = vocabulary.logs, vocabulary.longest, vocabulary.byte
    found: dict[str, tuple[int, float]] = {}
    stack = [(0.0, 0)]  # of each prefix of the word before: score and pieces
    before = ""
    for word in sorted(set(words)):
        marked = WORD_START + word
        shared = 0
        for a, b in zip(before, marked, strict=False):
            if a != b:
                break
            shared += 1
        del stack[shared + 1 :]
        for end in range(shared + 1, len(marked) + 1):
            best = None
            for begin in range(max(0, end - longest), end):
                log = logs.get(marked[begin:end])
                if log is not None:
                    score, n = stack[begin]
                    if best is None or score + log > best[0]:
                        best = (score + log, n + 1)
            if best is None or marked[end - 1] not in logs:
                n_bytes = len(marked[end - 1].encode())
                score, n = stack[end - 1]
                if best is None or score + n_bytes * byte > best[0]:
                    best = (score + n_bytes * byte, n + n_bytes)
            stack.append(best)
        found[word] = (stack[-1][1], stack[-1][0])
        before = marked
    return found


COUNTED = "doc_id long, n_words long, n_tokens long, score double"


def _count(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sentencepiece_vocabulary(path)
        known: dict[str, tuple[int, float]] = {}
        for batch in batches:
            docs = [Counter(w.decode() for w in (t.as_py() or "").encode().split()) for t in batch["text"]]
            fresh = {word for doc in docs for word in doc if word not in known}
            if len(known) + len(fresh) > MOST_WORDS:
                known, fresh = {}, {word for doc in docs for word in doc}
            known |= terminal_counts(list(fresh), vocabulary)
            tokens = [sum(n * known[w][0] for w, n in doc.items()) for doc in docs]
            scores = [math.fsum(n * known[w][1] for w, n in doc.items()) for doc in docs]
            arrays = [pa.array([doc.total() for doc in docs], pa.int64()), pa.array(tokens, pa.int64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], ["doc_id", "n_words", "n_tokens", "score"])

    return count


def counted(docs: DataFrame, path: str) -> DataFrame:
    """Per document its words, its tokens in the best segmentation, and that one's log probability."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_count(path), COUNTED)
