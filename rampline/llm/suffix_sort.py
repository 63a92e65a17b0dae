"""Suffix sorting by induction in external memory.

As usual, suffixes are of type L or S, the leftmost S of each run is sampled, the samples
are sorted by recursion on their names, and all other suffixes follow from them: first the
L suffixes in ascending, then the S suffixes in descending order. The suffixes that wait
for their turn lie in a priority queue of tuples (character, order of the suffix they
follow from, place). The queue is cut into bins of neighbouring characters; tuples beyond a
bound are written to the bin's file, and one bin at a time is read and put in order. Texts
and samples of all levels are memory-mapped files. So a bin has to fit in memory, a text
need not.

Names need no order beyond that of the samples' strings, so a level ends the recursion as
soon as all its names differ.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from tempfile import TemporaryDirectory

import numpy as np

ITEMS_IN_MEMORY = 4_000_000
ITEMS_PER_BIN = 200_000


class Queue:
    """Tuples of whole numbers by bin, beyond a bound on disk."""

    def __init__(self, folder: str, name: str, bins: int, width: int) -> None:
        self.path, self.width = os.path.join(folder, name), width
        self.parts: list[list[np.ndarray]] = [[] for _ in range(bins)]
        self.held = 0

    def push(self, bins: np.ndarray, *columns: np.ndarray) -> None:
        if not len(bins):
            return
        order = np.argsort(bins.astype(np.int16) if len(self.parts) < 1 << 15 else bins, kind="stable")
        rows = np.stack([np.asarray(c, np.int64)[order] for c in columns], 1)
        first, at = np.unique(bins[order], return_index=True)
        for b, begin, end in zip(first, at, [*at[1:], len(rows)], strict=True):
            self.parts[b].append(rows[begin:end])
        self.held += len(rows)
        if self.held > ITEMS_IN_MEMORY:
            for b, parts in enumerate(self.parts):
                if parts:
                    with open(f"{self.path}-{b}", "ab") as file:
                        np.concatenate(parts).tofile(file)
                    self.parts[b] = []
            self.held = 0

    def pop(self, b: int) -> np.ndarray:
        """All tuples of a bin, in the order they came."""
        parts = self.parts[b]
        self.parts[b] = []
        self.held -= sum(map(len, parts))
        if os.path.exists(f"{self.path}-{b}"):
            parts = [np.fromfile(f"{self.path}-{b}", np.int64).reshape(-1, self.width), *parts]
            os.remove(f"{self.path}-{b}")
        return np.concatenate(parts) if parts else np.zeros((0, self.width), np.int64)


def on_disk(folder: str, name: str, values: np.ndarray) -> np.ndarray:
    path = os.path.join(folder, name)
    values.tofile(path)
    # a plain array over the mapped file: indexing is faster without the subclass
    return np.asarray(np.memmap(path, values.dtype, "r", shape=values.shape)) if len(values) else values


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S; the last one is."""
    n = len(text)
    kind = np.ones(n, bool)
    if n > 1:
        # a suffix has the type of the next place where neighbours differ
        place = np.where(text[:-1] != text[1:], np.arange(n - 1), n - 2)
        following = np.minimum.accumulate(place[::-1])[::-1]
        kind[:-1] = text[following] < text[following + 1]
    return kind


def _bins(text: np.ndarray) -> np.ndarray:
    """The first character of each bin: as many characters as make up a bin, but whole ones."""
    found, counts = np.unique(text, return_counts=True)
    before = np.cumsum(counts) - counts
    new = np.flatnonzero(np.diff(before // ITEMS_PER_BIN, prepend=-1))
    return found[new]


FIRST, INSIDE, LAST = 0, 1, 2  # order of suffixes with the same first character


def _ranked(char: np.ndarray, kind: np.ndarray, key: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Ranks of suffixes by (char, kind, key), where the key of those inside is their parent's rank.

    Ranks of those inside are refined along their chains of parents, twice as far each time.
    """
    n = len(char)
    order = _sorted_by(char, kind, key)
    new = np.ones(n, bool)
    new[1:] = (char[order[1:]] != char[order[:-1]]) | (kind[order[1:]] != kind[order[:-1]]) | (kind[order[1:]] != INSIDE)
    place = np.arange(n)
    start = np.maximum.accumulate(np.where(new, place, 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    jump = np.where(parent >= 0, parent, place)
    open_ = order[_tied(new)]
    while len(open_):
        both = rank[open_] * n + rank[jump[open_]]
        order = np.argsort(both)
        both, open_ = both[order], open_[order]
        old, place = both // n, np.arange(len(open_))
        begins = np.diff(old, prepend=-1) != 0
        new = np.diff(both, prepend=-1) != 0
        group = np.maximum.accumulate(np.where(begins, place, 0))
        part = np.maximum.accumulate(np.where(new, place, 0))
        rank[open_] = old + part - group
        jump = jump[jump]
        open_ = open_[_tied(new)]
    return rank


def _sorted_by(char: np.ndarray, kind: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The order by (char, kind, key), from one number for all three where it holds them."""
    if not len(char):
        return np.zeros(0, np.int64)
    first, least = int(char.min()), int(key.min())
    bits = (int(key.max()) - least).bit_length()
    if (int(char.max()) - first + 1).bit_length() + 2 + bits > 62:
        return np.lexsort((key, kind, char))
    return np.argsort((((char.astype(np.int64) - first) * 3 + kind) << bits) | (key - least))


def _tied(begins: np.ndarray) -> np.ndarray:
    """Members of runs longer than one, given where runs begin."""
    return ~(begins & np.append(begins[1:], True))


class Induction:
    """One level: sorts all suffixes of ``text``, whose last character is its smallest and unique."""

    def __init__(self, text: np.ndarray, folder: str, level: int) -> None:
        self.text, self.folder, self.level = text, folder, level
        self.kind = _types(text)
        self.sampled = np.flatnonzero(self.kind[1:] & ~self.kind[:-1]) + 1
        self.bins = _bins(text)
        self.runs = 0
        self.bin_of_char = np.zeros(int(text.max()) + 1, np.int32)
        self.bin_of_char[self.bins[1:]] = 1
        self.bin_of_char = np.cumsum(self.bin_of_char, dtype=np.int32)

    def bin_of(self, chars: np.ndarray) -> np.ndarray:
        return self.bin_of_char[chars]

    def _closure(self, place: np.ndarray, b: int, s_type: bool) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes of the bin that follow from those at ``place``, one after another, with their parents."""
        places, parents = [place], [np.full(len(place), -1)]
        front, at = place, np.arange(len(place))
        begin = len(place)
        while len(front):
            keep = front > 0
            front, at = front[keep] - 1, at[keep]
            keep = (self.kind[front] == s_type) & (self.bin_of(self.text[front]) == b)
            front, at = front[keep], at[keep]
            places.append(front)
            parents.append(at)
            at = np.arange(begin, begin + len(front))
            begin += len(front)
        return np.concatenate(places), np.concatenate(parents)

    def _push(self, queue: Queue, place: np.ndarray, order: np.ndarray, b: int, s_type: bool) -> None:
        """The suffixes that follow from those at ``place`` in other bins."""
        keep = place > 0
        before, order = place[keep] - 1, order[keep]
        bins = self.bin_of(self.text[before])
        keep = (self.kind[before] == s_type) & (bins != b)
        queue.push(bins[keep], order[keep], before[keep])

    def run(self, samples: np.ndarray) -> Iterator[np.ndarray]:
        """Places of all suffixes by bin, bins descending, ascending within, given the samples in order."""
        self.runs += 1
        n_bins, name = len(self.bins), f"{self.level}-{self.runs}"
        waiting = Queue(self.folder, f"sample-{name}", n_bins, 2)
        waiting.push(self.bin_of(self.text[samples]), np.arange(len(samples)), samples)
        queue, done, counter = Queue(self.folder, f"l-{name}", n_bins, 2), Queue(self.folder, f"sorted-{name}", n_bins, 1), 0
        for b in range(n_bins):
            given, induced = waiting.pop(b), queue.pop(b)
            place, parent = self._closure(np.concatenate([given[:, 1], induced[:, 1]]), b, False)
            kind = np.full(len(place), INSIDE)
            kind[: len(given)], kind[len(given) : len(given) + len(induced)] = LAST, FIRST
            key = np.zeros(len(place), np.int64)
            key[: len(given)], key[len(given) : len(given) + len(induced)] = given[:, 0], induced[:, 0]
            rank = _ranked(np.asarray(self.text[place]), kind, key, parent)
            order = np.argsort(rank)
            self._push(queue, place, counter + rank, b, False)
            counter += len(place)
            left = order[kind[order] != LAST]
            done.push(np.full(len(left), b), place[left])
        queue, counter = Queue(self.folder, f"s-{name}", n_bins, 2), 0
        for b in range(n_bins - 1, -1, -1):
            left, induced = done.pop(b)[:, 0], queue.pop(b)
            last = np.array([len(self.text) - 1] if b == 0 else [], np.int64)
            place, parent = self._closure(np.concatenate([left, last, induced[:, 1]]), b, True)
            known = len(left) + len(last)
            kind = np.full(len(place), INSIDE)
            kind[:known], kind[known : known + len(induced)] = FIRST, LAST
            key = np.zeros(len(place), np.int64)
            key[: len(left)], key[known : known + len(induced)] = np.arange(len(left)), induced[:, 0]
            rank = _ranked(np.asarray(self.text[place]), kind, key, parent)
            counter -= len(place)
            self._push(queue, place, counter + rank, b, True)
            yield place[np.argsort(rank)]

    def sample_order(self) -> np.ndarray:
        """The samples in the order of their suffixes."""
        sampled = self.sampled
        if len(sampled) < 2:
            return sampled
        is_sample = np.zeros(len(self.text), bool)
        is_sample[sampled] = True
        parts = [part[is_sample[part]] for part in self.run(sampled)]
        by_name = np.concatenate(parts[::-1])
        names = np.cumsum(self._new_names(by_name))
        number = np.empty(len(self.text), np.int64)
        number[by_name] = names
        if names[-1] == len(by_name) - 1:
            return by_name
        reduced = on_disk(self.folder, f"text-{self.level + 1}", number[sampled])
        del number, is_sample
        deeper = Induction(reduced, self.folder, self.level + 1)
        return sampled[np.concatenate(list(deeper.run(deeper.sample_order()))[::-1])]

    def _new_names(self, by_name: np.ndarray) -> np.ndarray:
        """Whether the string from each sample to the next differs from that of the sample before."""
        following = np.append(self.sampled[1:], len(self.text) - 1)
        length = following[np.searchsorted(self.sampled, by_name)] - by_name + 1
        new = np.ones(len(by_name), np.int64)
        new[0] = 0
        # the last sample, the unique last character, equals no other
        same = np.flatnonzero((length[1:] == length[:-1]) & (length[1:] > 1)) + 1
        offset = 0
        while len(same):
            equal = self.text[by_name[same] + offset] == self.text[by_name[same - 1] + offset]
            same = same[equal]
            over = length[same] == offset + 1
            new[same[over]] = 0
            same, offset = same[~over], offset + 1
        return new


def sorted_suffixes(text: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the suffixes of ``text`` in order, in blocks; its last character must be unique and smallest."""
    with TemporaryDirectory(prefix="suffixes-") as folder:
        level = Induction(on_disk(folder, "text-0", text), folder, 0)
        blocks = Queue(folder, "blocks", len(level.bins), 1)
        samples = on_disk(folder, "samples", level.sample_order())
        for b, block in zip(range(len(level.bins) - 1, -1, -1), level.run(np.asarray(samples)), strict=True):
            blocks.push(np.full(len(block), b), block)
        for b in range(len(level.bins)):
            yield blocks.pop(b)[:, 0]
