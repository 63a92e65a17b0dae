"""Scoring texts with a gated recurrent language model.

The model predicts a word in two steps, its class and the word within the class. Frequent
words are grouped into classes by rank; all other words, unseen ones included, are one
class within which counts decide. A fixed share of the probability stays with the smoothed
counts alone, so every token has a positive probability and all of them sum to one.

Training covers every training document once: the documents are dealt over rounds, of
which a larger corpus has more, and in each round every task trains its own copy of the parameters on its part, by backpropagation cut
off at a window's start while the state is carried on, and the copies are averaged by
Spark, part by part of the parameter vector, as are the sums of squares that set their rates. Scoring carries the state through all windows
of a document.

Counts are exact for every word: those of frequent words are sent to the tasks (a bounded
number), those of all others are joined.

Edge cases: null and empty texts are the closing token only. A null id counts as the empty
text when documents are held out. Repeated rows are scored, and learned from, each. Without
training documents the model is the one it starts as. Long texts are scored whole. An empty
table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from rampline.llm.common import as_text, written

END = b""  # no word is empty
MODEL_WORDS = 8191
LOOKUP_WORDS = 200_000
CLASSES = 64
EMBEDDING, HIDDEN = 32, 32
STREAMS, WINDOW = 512, 16
TOKENS_OF_TWO_ROUNDS = 50_000_000  # twice as many take one round more
TOKENS_PER_COPY = 500_000
TOKENS_AT_ONCE = 1_000_000  # learned from, in parallel streams
TOKENS_SCORED_AT_ONCE = 6_000_000  # many, so that a very long document has others beside it
RATE = 0.1
SHARE = 0.95  # of the network; the rest is that of the counts
COUNTED_AT_ONCE = 4_000_000
BYTES_AT_ONCE = 8_000_000  # of texts, cut into words together
PART = 16_384  # parameters averaged together


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


# ---- the network ----------------------------------------------------------------------


@dataclass
class Shape:
    """Words 0 to n-1 have classes of their own kind; word n stands for all others."""

    starts: np.ndarray  # first word of each class, and n
    counts: np.ndarray  # of the words, and at the end of all others together

    @property
    def n(self) -> int:
        return int(self.starts[-1])

    def class_of(self) -> np.ndarray:
        return np.append(np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts)), len(self.starts) - 1)


def shape_of(counts: np.ndarray, others: float) -> Shape:
    """Classes of about equal sums of root counts, so that frequent words have small classes."""
    weight = np.cumsum(np.sqrt(counts + 0.5))
    bins = np.minimum((CLASSES * (weight - weight[0]) / weight[-1]).astype(int), CLASSES - 1)
    starts = np.append(np.flatnonzero(np.diff(bins, prepend=-1)), len(counts))
    return Shape(starts, np.append(counts, others).astype(float))


def _layout(shape: Shape) -> dict[str, tuple[int, ...]]:
    classes = len(shape.starts)
    return {
        "embed": (shape.n + 1, EMBEDDING),
        "input": (EMBEDDING, 3 * HIDDEN),
        "state": (HIDDEN, 3 * HIDDEN),
        "gates": (3 * HIDDEN,),
        "to_class": (HIDDEN, classes),
        "class_bias": (classes,),
        "to_word": (shape.n, HIDDEN),
        "word_bias": (shape.n,),
    }


def views(flat: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    found, at = {}, 0
    for name, size in _layout(shape).items():
        found[name] = flat[at : at + int(np.prod(size))].reshape(size)
        at += int(np.prod(size))
    return found


def initial(shape: Shape) -> np.ndarray:
    """Parameters that give every word its frequency, whatever came before."""
    random = np.random.default_rng(0)
    flat = np.zeros(sum(int(np.prod(s)) for s in _layout(shape).values()), np.float32)
    p = views(flat, shape)
    p["embed"][:] = random.normal(0, 0.3, p["embed"].shape)
    p["input"][:] = random.normal(0, EMBEDDING**-0.5, p["input"].shape)
    p["state"][:] = random.normal(0, HIDDEN**-0.5, p["state"].shape)
    smooth = shape.counts + 0.5
    p["class_bias"][:] = np.log(np.add.reduceat(smooth, shape.starts))
    p["word_bias"][:] = np.log(smooth[:-1])
    return flat


class Space:
    """Arrays that each window fills anew: making them anew takes as long as much of what is computed in them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *size: int) -> np.ndarray:
        n, own = math.prod(size), self.held.get(name)
        if own is None or len(own) < n:
            own = self.held[name] = np.empty(n, np.float32)
        return own[:n].reshape(size)


def _taken(rows: np.ndarray, at: np.ndarray, out: np.ndarray) -> np.ndarray:
    if rows.dtype != out.dtype:
        rows = rows.astype(out.dtype)
    return np.take(rows, at, 0, out=out, mode="clip")


MULTIPLIED_AT_ONCE = 1_000_000  # by the BLAS without packing the matrices first


def _in_pieces(rows: np.ndarray, width: int) -> tuple[int, int]:
    """How many rows to multiply at once for a result so wide, and how many rows these pieces cover."""
    step = max(1, min(len(rows), MULTIPLIED_AT_ONCE // (rows.shape[1] * width)))
    return step, len(rows) // step * step


def _product(rows: np.ndarray, weights: np.ndarray, out: np.ndarray) -> np.ndarray:
    """rows @ weights."""
    step, whole = _in_pieces(rows, weights.shape[1])
    np.matmul(rows[:whole].reshape(-1, step, rows.shape[1]), weights, out=out[:whole].reshape(-1, step, weights.shape[1]))
    if whole < len(rows):
        np.matmul(rows[whole:], weights, out=out[whole:])
    return out


def _summed(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """rows.T @ others."""
    step, whole = _in_pieces(rows, others.shape[1])
    pieces = rows[:whole].reshape(-1, step, rows.shape[1]).transpose(0, 2, 1)
    total = np.matmul(pieces, others[:whole].reshape(-1, step, others.shape[1])).sum(0)
    return total if whole == len(rows) else total + rows[whole:].T @ others[whole:]


def _by_gate(weights: np.ndarray) -> np.ndarray:
    """The weights of each gate, which lie side by side, as a matrix of its own."""
    return np.ascontiguousarray(weights.reshape(len(weights), 3, HIDDEN).transpose(1, 0, 2))


def inputs_of(p: dict, words: np.ndarray | slice) -> np.ndarray:
    """What each of these words adds to the gates (gates x words x hidden)."""
    embedded, gates = p["embed"][words], p["gates"].reshape(3, 1, HIDDEN)
    table = np.empty((3, len(embedded), HIDDEN), np.float32)
    for weights, own in zip(_by_gate(p["input"]), table, strict=True):
        _product(embedded, weights, own)
    table += gates
    return table


def _recurrent(p: dict) -> np.ndarray:
    """Weights of the state by gate; those of the new state by half, as its gate is twice as open as below."""
    recurrent = _by_gate(p["state"])
    recurrent[2] *= 0.5
    return recurrent


def _run(
    p: dict, words: np.ndarray, fresh: np.ndarray, state: np.ndarray, space: Space | None = None, table: np.ndarray | None = None
) -> np.ndarray:
    """States (steps x streams x hidden) of a window, which begins with ``state`` (hidden x streams).

    ``space`` holds what backpropagation needs, if ``table`` is not given. Every gate has arrays of its own, so that they are
    contiguous. A gate is (1 + tanh) / 2 of its input; what is held is twice that, 1 + tanh.
    ``table`` are the inputs of all words, if known; else those of the window's words are made, each once.
    """
    (steps, width), space, place, kept = words.shape, space or Space(), words, 1
    if table is None:
        kept = steps
        own = np.flatnonzero(np.bincount(words.ravel()))
        table, numbers = inputs_of(p, own), np.empty(len(p["embed"]), np.int64)
        numbers[own] = np.arange(len(own))
        place = numbers[words]
    place = place[:, None, :] + np.arange(3)[:, None] * table.shape[1]
    table, recurrent = table.reshape(-1, HIDDEN), _recurrent(p)
    given, carried = (space(name, 3, width, HIDDEN) for name in ("given", "carried"))
    gates, states = space("gates", kept, 2, width, HIDDEN), space("states", steps, width, HIDDEN)
    before, new, drawn = (space(name, kept, width, HIDDEN) for name in ("before", "new", "drawn"))
    state = state.T
    for t in range(steps):
        last, gate, fill, taken = (own[t % kept] for own in (before, gates, new, drawn))
        last[:] = state
        last[fresh[t]] = 0
        _taken(table, place[t], given)
        np.matmul(last, recurrent, out=carried)
        np.add(given[:2], carried[:2], out=gate)
        np.tanh(gate, out=gate)
        gate += 1
        np.multiply(gate[1], carried[2], out=taken)
        np.add(taken, given[2], out=fill)
        np.tanh(fill, out=fill)
        state = states[t]
        np.subtract(last, fill, out=state)
        state *= gate[0]
        state *= 0.5
        state += fill
    return states


def _rows(states: np.ndarray) -> np.ndarray:
    """One row per step and stream."""
    return states.reshape(-1, HIDDEN)


class Biases(NamedTuple):
    """Exponentials of biases, at most one in each softmax, and of which softmaxes they serve.

    They do if no score of any state is so large that products with them leave the normal numbers;
    where they do not, they are one, and a softmax adds its biases to its scores.
    """

    of_class: np.ndarray
    class_serves: bool
    of_word: np.ndarray
    words_serve: list[bool]


def biases(p: dict, shape: Shape, reach: float, space: Space | None = None) -> Biases:
    """For states whose numbers are not beyond ``reach``."""

    space = space or Space()

    def factors(weights: np.ndarray, bias: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bool]]:
        absolute = np.abs(weights, out=space("absolute", *weights.shape))
        around = absolute @ np.full(weights.shape[1], reach, np.float32)
        begins, sizes = starts[:-1], np.diff(starts)
        most = np.maximum.reduceat(bias, begins)
        serves = np.maximum.reduceat(around, begins) + most - np.minimum.reduceat(bias, begins) < 60
        below = np.where(np.repeat(serves, sizes), bias - np.repeat(most, sizes), 0)
        return np.exp(below, dtype=np.float32, casting="same_kind"), serves.tolist()

    of_class, (serves,) = factors(p["to_class"].T, p["class_bias"], np.array([0, len(p["class_bias"])]))
    return Biases(of_class, serves, *factors(p["to_word"], p["word_bias"], shape.starts))


def _reach(states: np.ndarray) -> float:
    return max(states.max(initial=0), -states.min(initial=0))


def _exponentials(rows: np.ndarray, weights: np.ndarray, bias: np.ndarray, serves: bool, out: np.ndarray) -> np.ndarray:
    """Per row what a softmax, times the factors of its biases, divides by its sum."""
    x = _product(rows, weights, out)
    if not serves:
        x += bias
        x -= x.max(1, keepdims=True)
    return np.exp(x, out=x)


def _by_class(shape: Shape, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by class, and how many each class of words has; last come the rows of all other words."""
    order = np.argsort(classes.astype(np.uint16), kind="stable")  # a radix sort
    return order, np.bincount(classes, minlength=len(shape.starts))[:-1]


class Within(NamedTuple):
    """Softmaxes within the classes of words, for rows by class."""

    exponentials: np.ndarray  # rows end to end
    blocks: list[tuple[np.ndarray, int, int, int, int]]  # of one class each, with its rows and its words
    totals: np.ndarray  # by row
    aims: np.ndarray  # where each row's target lies among the exponentials
    factors: np.ndarray  # of the targets


def _within(p: dict, shape: Shape, bias: Biases, rows: np.ndarray, targets: np.ndarray, n_rows: np.ndarray, space: Space) -> Within:
    widths, ends = np.diff(shape.starts), np.cumsum(n_rows)
    upto = np.cumsum(n_rows * widths)
    n, x = int(ends[-1]), space("within", int(upto[-1]))
    totals, blocks, first, at = np.empty(n, np.float32), [], 0, 0
    for last, to, begin, end, serves in zip(ends.tolist(), upto.tolist(), shape.starts.tolist(), shape.starts[1:].tolist(), bias.words_serve):
        if last > first:
            block = x[at:to].reshape(last - first, end - begin)
            _exponentials(rows[first:last], p["to_word"][begin:end].T, p["word_bias"][begin:end], serves, block)
            np.matmul(block, bias.of_word[begin:end], out=totals[first:last])
            blocks.append((block, first, last, begin, end))
            first, at = last, to
    # of row r of a class: its block's begin, the block's rows before r, and the target's number in the class
    before = upto - ends * widths - shape.starts[:-1]
    targets = targets[:n]
    aims = np.repeat(before, n_rows) + np.arange(n) * np.repeat(widths, n_rows) + targets
    return Within(x, blocks, totals, aims, bias.of_word[targets])


ROWS_AT_ONCE = 512  # of scores for all classes, which a core's cache holds


def probabilities(
    p: dict, shape: Shape, classes: np.ndarray, states: np.ndarray, targets: np.ndarray, space: Space | None = None, bias: Biases | None = None
) -> np.ndarray:
    """Of each target by the network; of the class alone for the class of all other words."""
    kind, space = classes[targets], space or Space()
    chance = np.empty(len(kind))
    bias = bias or biases(p, shape, _reach(states))
    n_classes = len(bias.of_class)
    for begin in range(0, len(kind), ROWS_AT_ONCE):
        own = kind[begin : begin + ROWS_AT_ONCE]
        out = space("scores", len(own), n_classes)
        x = _exponentials(states[begin : begin + len(own)], p["to_class"], p["class_bias"], bias.class_serves, out)
        chance[begin : begin + len(own)] = x.ravel()[np.arange(0, x.size, n_classes) + own] / (x @ bias.of_class)
    chance *= bias.of_class[kind]
    order, n_rows = _by_class(shape, kind)
    states = _taken(states, order, space("sorted", *states.shape))
    own = _within(p, shape, bias, states, targets[order], n_rows, space)
    chance[order[: len(own.aims)]] *= own.exponentials[own.aims] * own.factors / own.totals
    return chance


def gradient(
    p: dict, shape: Shape, classes: np.ndarray, words, targets, fresh, state, space: Space | None = None, g: dict | None = None
) -> tuple[dict, np.ndarray]:
    """Of the log loss of one window, as a mean over a full one, and the state that is carried on.

    ``g`` is filled if given; it and the state hold until the next call with the same ``space``.
    """
    space = space or Space()
    states = _run(p, words, fresh, state, space)
    g = {name: np.empty_like(value) for name, value in p.items()} if g is None else g
    for value in g.values():
        value[:] = 0
    steps, width = words.shape
    kind, scale = classes[targets], np.float32(1 / (STREAMS * WINDOW))
    back, bias = space("back", steps, width, HIDDEN), biases(p, shape, max(1.0, _reach(state)), space)  # no state goes beyond 1 unless it began there
    weights = np.ascontiguousarray((p["to_class"] * bias.of_class).T)
    ones, each_row = np.ones(width, np.float32), np.arange(width) * len(bias.of_class)
    for t in range(steps):
        out = space("scores", width, len(bias.of_class))
        x = _exponentials(states[t], p["to_class"], p["class_bias"], bias.class_serves, out)
        # the softmax less one at the target, divided by the factors
        total = x @ bias.of_class
        x.ravel()[each_row + kind[t]] -= total / bias.of_class[kind[t]]
        x *= (scale / total)[:, None]
        g["to_class"] += _summed(states[t], x)
        g["class_bias"] += ones @ x
        _product(x, weights, back[t])
    g["to_class"] *= bias.of_class
    g["class_bias"] *= bias.of_class
    order, n_rows = _by_class(shape, kind.ravel())
    rows = _taken(_rows(states), order, space("sorted", steps * width, HIDDEN))
    own = _within(p, shape, bias, rows, targets.ravel()[order], n_rows, space)
    own.exponentials[own.aims] -= own.totals / own.factors
    n, share = len(own.aims), (scale / own.totals)[:, None]
    rows[:n] *= share
    inside = space("inside", steps * width, HIDDEN)
    inside[n:] = 0
    weights = np.multiply(p["to_word"], bias.of_word[:, None], out=space("weights", *p["to_word"].shape))
    for error, first, last, begin, end in own.blocks:
        np.matmul(error.T, rows[first:last], out=g["to_word"][begin:end])
        np.matmul(share[first:last, 0], error, out=g["word_bias"][begin:end])
        np.matmul(error, weights[begin:end], out=inside[first:last])
    inside[:n] *= share
    g["to_word"] *= bias.of_word[:, None]
    g["word_bias"] *= bias.of_word
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    back += _taken(inside, place, space("rows", steps * width, HIDDEN)).reshape(back.shape)

    gates = space("gates", steps, 2, width, HIDDEN)
    before, new, drawn = (space(name, steps, width, HIDDEN) for name in ("before", "new", "drawn"))
    # by what is recurrent of the new state, by the two gates, and by all of the new state
    pull = space("pull", 4, width, HIDDEN)
    slope, through = space("slope", 2, width, HIDDEN), space("through", 3, width, HIDDEN)
    d, kept, carry = (space(name, width, HIDDEN) for name in ("d", "kept", "carry"))
    recurrent = np.ascontiguousarray(_recurrent(p)[[2, 0, 1]].transpose(0, 2, 1))
    entering = np.ascontiguousarray(_by_gate(p["input"]).transpose(0, 2, 1))
    embedded = _taken(p["embed"], words.ravel(), space("embedded", steps * width, EMBEDDING)).reshape(steps, width, EMBEDDING)
    g_state, g_input, g_gates = np.zeros((3, HIDDEN, HIDDEN)), np.zeros((3, EMBEDDING, HIDDEN)), np.zeros((3, HIDDEN))
    each, added = space("rows", steps, width, EMBEDDING), space("added", 3, width, EMBEDDING)
    carry[:] = 0
    for t in range(steps - 1, -1, -1):
        update, reset = gates[t]
        np.add(back[t], carry, out=d)
        np.multiply(d, update, out=kept)
        kept *= 0.5
        np.subtract(2, gates[t], out=slope)
        np.multiply(new[t], new[t], out=pull[3])
        np.subtract(1, pull[3], out=pull[3])
        np.subtract(states[t], new[t], out=pull[1])
        pull[1] *= d
        d -= kept
        pull[3] *= d
        np.multiply(pull[3], drawn[t], out=pull[2])
        pull[1:3] *= slope
        np.multiply(pull[3], reset, out=pull[0])
        np.matmul(pull[:3], recurrent, out=through)
        np.add(through[0], through[1], out=carry)
        carry += through[2]
        carry += kept
        carry[fresh[t]] = 0
        np.matmul(pull[1:], entering, out=added)
        np.add(added[0], added[1], out=each[t])
        each[t] += added[2]
        g_state += np.matmul(before[t].T, pull[:3])
        g_input += np.matmul(embedded[t].T, pull[1:])
        g_gates += ones @ pull[1:]
    g_state[0] *= 0.5  # its gate was twice as open
    g["state"][:] = g_state[[1, 2, 0]].transpose(1, 0, 2).reshape(HIDDEN, -1)
    g["input"][:] = g_input.transpose(1, 0, 2).reshape(EMBEDDING, -1)
    g["gates"][:] = g_gates.ravel()
    inputs = words.ravel()
    order = np.argsort(inputs.astype(np.uint16), kind="stable")
    inputs = inputs[order]
    starts = np.flatnonzero(np.diff(inputs, prepend=-1))
    each = _taken(each.reshape(-1, EMBEDDING), order, space("sorted", steps * width, EMBEDDING))
    # two numbers at a time
    g["embed"][inputs[starts]] = np.add.reduceat(each.view(np.complex64), starts, axis=0).view(np.float32)
    return g, states[-1].copy().T


# ---- learning -------------------------------------------------------------------------


class Learner:
    """One copy of the parameters, trained on whatever documents it is given."""

    def __init__(self, flat: np.ndarray, shape: Shape, squares: np.ndarray | None = None) -> None:
        self.flat, self.shape, self.classes = flat.copy(), shape, shape.class_of()
        self.p = views(self.flat, shape)
        self.seen, self.squares = 0, np.full_like(flat, 1e-8) if squares is None else squares.copy()
        self.step, self.space = np.empty_like(self.flat), Space()
        self.g = views(self.step, shape)

    def learn(self, stream: np.ndarray, end: int) -> None:
        """From the documents in ``stream``, each closed by ``end``, cut into parallel streams."""
        streams = max(1, min(STREAMS, len(stream) // WINDOW))
        steps = len(stream) // streams
        before = np.concatenate([[end], stream[:-1]])
        self.seen += len(stream)
        # what does not fill the last row of the streams is learned from as one more stream
        bodies = [(streams, 0), (1, streams * steps)]
        for width, begin in bodies:
            size = (len(stream) - begin) // width if width > 1 or begin else steps
            if not size:
                continue
            aim = stream[begin : begin + width * size].reshape(width, size).T
            given = before[begin : begin + width * size].reshape(width, size).T
            state = np.zeros((HIDDEN, width), np.float32)
            for t in range(0, size, WINDOW):
                words = given[t : t + WINDOW]
                own = words, aim[t : t + WINDOW], words == end, state
                _, state = gradient(self.p, self.shape, self.classes, *own, self.space, self.g)
                self._move()

    def _move(self) -> None:
        """One step down the gradient, some parameters at a time, which a core's cache holds."""
        for begin in range(0, len(self.flat), PART):
            flat, squares, step = (own[begin : begin + PART] for own in (self.flat, self.squares, self.step))
            squares += step * step
            step *= np.float32(RATE)
            step /= np.sqrt(squares)
            flat -= step


def _learn(flat: np.ndarray, squares: np.ndarray, shape: Shape, end: int):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, held, size = Learner(flat, shape, squares), [], 0
        for batch in batches:
            for ids in batch["ids"]:
                own = np.frombuffer(ids.as_buffer(), "<u2").astype(np.int64)
                held.append(own)
                size += len(own)
                if size >= TOKENS_AT_ONCE:
                    learner.learn(np.concatenate(held), end)
                    held, size = [], 0
        if held:
            learner.learn(np.concatenate(held), end)
        if learner.seen:
            whole = np.concatenate([learner.flat, learner.squares])
            whole = (whole.astype(np.float64) * learner.seen).astype(np.float32)
            parts = [whole[at : at + PART].tobytes() for at in range(0, len(whole), PART)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([learner.seen] * len(parts), pa.int64()), pa.array(parts, pa.binary())],
                ["part", "seen", "sums"],
            )

    return learn


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the copies of each part; rows come by part."""
    sums: dict[int, list] = {}
    for batch in batches:
        for part, seen, values in zip(*(batch[c].to_pylist() for c in ("part", "seen", "sums")), strict=True):
            own = sums.setdefault(part, [0, 0.0])
            own[0] += seen
            own[1] = own[1] + np.frombuffer(values, np.float32).astype(np.float64)
    parts = sorted(sums)
    mean = [(sums[k][1] / sums[k][0]).astype(np.float32).tobytes() for k in parts]
    yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(mean, pa.binary())], ["part", "mean"])


def rounds_for(n_tokens: int) -> int:
    """How often copies are averaged: once more for each doubling of the corpus, at least twice."""
    return 2 + max(0, (int(n_tokens) // TOKENS_OF_TWO_ROUNDS).bit_length() - 1)


def trained(ids: DataFrame, shape: Shape, end: int, n_tokens: int) -> np.ndarray:
    """Parameters after all rounds over the rows (round, ids)."""
    flat, rounds = initial(shape), rounds_for(n_tokens)
    squares = np.full_like(flat, 1e-8)
    copies = max(1, n_tokens // (rounds * TOKENS_PER_COPY))
    for number in range(rounds):
        mine = ids.where(F.col("round") == number).select("ids").coalesce(copies)
        sums = mine.mapInArrow(_learn(flat, squares, shape, end), "part int, seen long, sums binary")
        partitions = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # one vector of bounded size comes back, however many copies there were
        found = sums.repartition(partitions, "part").mapInArrow(_average, "part int, mean binary").toArrow()
        if found.num_rows:
            found = found.sort_by("part")
            both = np.concatenate([np.frombuffer(m.as_buffer(), np.float32) for m in found["mean"]])
            flat, squares = np.split(both, 2)
    return flat


# ---- scoring --------------------------------------------------------------------------


class Scorer:
    def __init__(self, flat: np.ndarray, shape: Shape, end: int, n_tokens: float, n_distinct: int) -> None:
        self.p, self.shape, self.end, self.classes = views(flat, shape), shape, end, shape.class_of()
        whole = n_tokens + 0.5 * (n_distinct + 1)
        others = n_distinct - int((shape.counts[:-1] > 0).sum())
        by_counts = (shape.counts + 0.5) / whole
        # all other words share their class by counts + 0.5, an unseen one by 0.5; that factor is added later
        by_counts[-1] = 1 / whole
        self.by_counts = by_counts
        self.within = 1 / (shape.counts[-1] + 0.5 * (others + 1))
        self.space, self.bias = Space(), biases(self.p, shape, 1.0)  # states that begin at 0 stay within 1
        self.table = inputs_of(self.p, slice(None))

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """log10 of the probability of each document, less the factors of words outside the model."""
        total = np.zeros(len(docs))
        if not docs:
            return total
        lanes: list[list[int]] = [[] for _ in range(min(STREAMS, len(docs)))]
        free = [(0, lane) for lane in range(len(lanes))]
        for at in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            used, lane = heapq.heappop(free)
            lanes[lane].append(at)
            heapq.heappush(free, (used + len(docs[at]), lane))
        lengths = np.array([sum(len(docs[i]) for i in lane) for lane in lanes])
        order = np.argsort(-lengths, kind="stable").tolist()
        lengths = lengths[order]
        ranked = [i for lane in order for i in lanes[lane]]
        starts = np.cumsum(lengths) - lengths
        tokens = np.concatenate([docs[i] for i in ranked])
        owners = np.repeat(ranked, [len(docs[i]) for i in ranked])
        before = np.concatenate([[self.end], tokens[:-1]]).astype(tokens.dtype)
        before[starts[lengths > 0]] = self.end
        state = np.zeros((HIDDEN, len(lanes)), np.float32)
        for t in range(0, int(lengths[0]), WINDOW):
            active = int((lengths > t).sum())
            steps = np.arange(t, min(t + WINDOW, int(lengths[0])))[:, None]
            real = steps < lengths[:active]
            at = np.where(real, starts[:active] + steps, 0)
            words = np.where(real, before[at], self.end)
            states = _run(self.p, words, words == self.end, state[:, :active], self.space, self.table)
            state = states[-1].copy().T
            real = real.ravel()
            rows, at = _rows(states), at.ravel()
            if not real.all():
                rows, at = rows[real], at[real]
            target = tokens[at].astype(np.int64)
            chance = probabilities(self.p, self.shape, self.classes, rows, target, self.space, self.bias)
            chance[target == self.shape.n] *= self.within
            logs = np.log10(SHARE * chance + (1 - SHARE) * self.by_counts[target])
            total += np.bincount(owners[at], logs, len(docs))
        return total


def _score(scorer: Scorer):
    def scored(held: list[pa.RecordBatch], docs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = scorer.score(docs)
        for batch in held:
            own, found = found[: batch.num_rows], found[batch.num_rows :]
            yield batch.append_column("network", pa.array(own))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size = [], [], 0
        for batch in batches:
            begin = 0
            for at, ids in enumerate(batch["ids"], 1):
                docs.append(np.frombuffer(ids.as_buffer(), "<u2"))
                size += len(docs[-1])
                if size >= TOKENS_SCORED_AT_ONCE or at == batch.num_rows:
                    held.append(batch.drop_columns(["ids"]).slice(begin, at - begin))
                    begin = at
                if size >= TOKENS_SCORED_AT_ONCE:
                    yield from scored(held, docs)
                    held, docs, size = [], [], 0
        if docs:
            yield from scored(held, docs)

    return score


# ---- counts ---------------------------------------------------------------------------


def all_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts end to end, A-Z lower-cased, and how many each text has."""
    held = [text or b"" for text in texts.cast(pa.binary()).to_pylist()]
    chars = np.frombuffer(b"\n".join([*held, b""]).lower(), np.uint8)
    inside = ~((chars == 32) | (chars - np.uint8(9) < 5))
    edges = np.flatnonzero(np.diff(inside, prepend=False))  # the last character is no word's
    begin, sizes = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(chars[inside])])
    return words, np.diff(np.searchsorted(begin, ends), prepend=0)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of some megabytes of text; a longer text is whole."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        before = int(sizes[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + BYTES_AT_ONCE, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts in this task, let go whenever there are many."""

    def rows(words: list[pa.Array], ends: int) -> pa.RecordBatch:
        counts = pa.chunked_array(words, pa.binary()).value_counts()
        values, n = counts.field("values"), counts.field("counts")
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([values, pa.array([END], pa.binary())]), pa.concat_arrays([n, pa.array([ends], pa.int64())])], ["word", "n"]
        )

    held, n_words, ends = [], 0, 0
    for batch in batches:
        for piece in _pieces(batch):
            words, sizes = all_words(piece["text"])
            held, n_words, ends = [*held, words], n_words + len(words), ends + len(sizes)
            if n_words > COUNTED_AT_ONCE:
                yield rows(held, ends)
                held, n_words, ends = [], 0, 0
    if ends:
        yield rows(held, ends)


ENCODED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, known_logs double, class_logs double, "
    "ids binary, words array<binary>, times array<int>"
)
SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, known_logs double, class_logs double, network double"


def _encode(known: list[bytes], counts: np.ndarray, n_model: int):
    """Ids of the model's words; logs of counts of known words; the words that are not known."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(known, pa.binary())
        logs = np.append(np.log10(counts + 0.5), 0.0)
        seen = np.append(counts > 0, False)

        def encoded(piece: pa.RecordBatch) -> pa.RecordBatch:
            words, sizes = all_words(piece["text"])
            words = words.dictionary_encode()
            n_distinct = max(1, len(words.dictionary))
            ranks = pc.fill_null(pc.index_in(words.dictionary, vocabulary), len(known)).to_numpy().astype(np.int64)
            which = words.indices.to_numpy()
            at = ranks[which]
            # the words that are not known, by document
            other = np.flatnonzero(at == len(known))
            pairs = np.repeat(np.arange(len(sizes)), sizes)[other] * n_distinct + which[other]
            pairs, times = np.unique(pairs, return_counts=True)
            doc, word = np.divmod(pairs, n_distinct)
            cuts = pa.array(np.searchsorted(doc, np.arange(len(sizes) + 1)).astype(np.int32))
            # the token that closes a document is the first of the known
            at = np.insert(at, np.cumsum(sizes), 0)
            starts = np.concatenate([[0], np.cumsum(sizes + 1)])
            own, first = logs[at], starts[:-1]
            ids, bytes_ = np.minimum(at, n_model).astype("<u2"), (2 * starts).astype(np.int32)
            arrays = [
                pa.array(sizes + 1),
                pa.array(np.add.reduceat(seen[at].astype(np.int64), first)),
                pa.array(np.add.reduceat(own, first)),
                pa.array(np.add.reduceat(np.where(at >= n_model, own, 0.0), first)),
                pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bytes_), pa.py_buffer(ids)]),
                pa.ListArray.from_arrays(cuts, words.dictionary.take(pa.array(word))),
                pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
            ]
            return pa.RecordBatch.from_arrays(
                [piece["row"], piece["doc_id"], piece["held_out"], *arrays],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "known_logs", "class_logs", "ids", "words", "times"],
            )

        for batch in batches:
            yield from map(encoded, _pieces(batch))

    return encode


def scored(docs: DataFrame) -> DataFrame:
    """Per document whether it was held out, its tokens, and its log10 probability by counts and by the model."""
    held = (F.crc32(as_text(F.col("doc_id")).cast("binary")) % 5 == 1).alias("held_out")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held, "text"
    )
    learned_from = rows.where(~F.col("held_out"))
    counts = learned_from.select("text").mapInArrow(_count, "word binary, n long")
    counts = written(counts.groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    n_tokens, n_distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("n"), "word").limit(LOOKUP_WORDS).toArrow()
    ranked = [(w, n) for w, n in zip(top["word"].to_pylist(), top["n"].to_pylist(), strict=True) if w != END]
    ends = counts.where(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known = [END, *[w for w, _ in ranked]]
    known_counts = np.array([ends, *[n for _, n in ranked]], np.float64)
    n_model = min(len(known), MODEL_WORDS)
    shape = shape_of(known_counts[:n_model], n_tokens - known_counts[:n_model].sum())

    encoded = rows.mapInArrow(_encode(known, known_counts, n_model), ENCODED)
    encoded = written(encoded, "lm-ids")

    to_learn = encoded.where(~F.col("held_out")).select(F.pmod(F.xxhash64("row"), F.lit(rounds_for(n_tokens))).alias("round"), "ids")
    flat = trained(to_learn, shape, 0, n_tokens)
    scorer = Scorer(flat, shape, 0, n_tokens, n_distinct)
    whole = encoded.drop("words", "times").mapInArrow(_score(scorer), SCORED)

    pairs = encoded.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
    pairs = pairs.select("row", F.col("w.words").alias("own"), F.col("w.times").alias("times"))
    joined = pairs.join(counts, F.col("own") == F.col("word"), "left")
    others = joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("other_logs"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("other_known"),
    )
    per_token = float(np.log10(n_tokens + 0.5 * (n_distinct + 1)))
    more = F.coalesce("other_logs", F.lit(0.0))
    return whole.join(others, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("other_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("known_logs") + more - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("network") + F.col("class_logs") + more).alias("score"),
    )
