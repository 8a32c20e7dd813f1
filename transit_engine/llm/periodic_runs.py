"""Runs: stretches of words that repeat with a period, such as a sentence said over and over.

The words of a text go into a suffix automaton. Its suffix links form a tree in which the path from
the state of a prefix to the root holds all suffixes of that prefix. The tree is kept as a link-cut
structure: the states on a path are cut into segments, each a splay tree with one colour, the place
where the strings of its states ended last. Appending word ``i`` accesses the path of its prefix,
which meets the old segments and leaves one segment of colour ``i``. A segment of colour ``e`` with
strings of up to ``m`` words says that the last ``m`` words were seen before at distance ``i - e``;
if that distance is ``m`` at most, a square of that period ends here. Every square whose period is
its smallest is met this way, and a square not within a run known already is extended to one. An
access costs logarithmic time on average, whatever the text.

A run of at least ``min_length`` words and two periods repeats ``min_length / 2`` words in a row, so
only stretches covered by sequences of that many words that occur again within the stretch go
through the automaton. This leaves out no run and is exact, as runs never cross such stretches.

Texts are independent of each other; nothing crosses the network.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
_BASE = np.uint64(0x9E3779B97F4A7C15)


class SuffixAutomaton:
    """States of the word sequence: ``length`` of the longest string, suffix ``link``, and the
    state of every prefix in ``prefix``. State 0 is the empty string."""

    def __init__(self, ids: list[int]):
        self.length, self.link, self.prefix = [0], [-1], []
        # Most states have one transition; only those with more have a dictionary.
        self.symbol, self.target, self.more = [-1], [-1], {}
        last = 0
        for symbol in ids:
            last = self._append(last, symbol)
            self.prefix.append(last)

    def _next(self, state: int, symbol: int) -> int:
        if self.symbol[state] == symbol:
            return self.target[state]
        more = self.more.get(state)
        return -1 if more is None else more.get(symbol, -1)

    def _connect(self, state: int, symbol: int, target: int) -> None:
        if self.symbol[state] in (-1, symbol):
            self.symbol[state], self.target[state] = symbol, target
        else:
            self.more.setdefault(state, {})[symbol] = target

    def _state(self, length: int, link: int, symbol: int = -1, target: int = -1) -> int:
        self.length.append(length)
        self.link.append(link)
        self.symbol.append(symbol)
        self.target.append(target)
        return len(self.length) - 1

    def _append(self, last: int, symbol: int) -> int:
        new, state = self._state(self.length[last] + 1, 0), last
        while state != -1 and (seen := self._next(state, symbol)) == -1:
            self._connect(state, symbol, new)
            state = self.link[state]
        if state == -1:
            return new
        if self.length[seen] != self.length[state] + 1:
            clone = self._state(
                self.length[state] + 1, self.link[seen], self.symbol[seen], self.target[seen]
            )
            if seen in self.more:
                self.more[clone] = dict(self.more[seen])
            while state != -1 and self._next(state, symbol) == seen:
                self._connect(state, symbol, clone)
                state = self.link[state]
            self.link[seen] = clone
            seen = clone
        self.link[new] = seen
        return new


class LastOccurrences:
    """The suffix links as a link-cut structure whose segments know where they occurred last."""

    def __init__(self, automaton: SuffixAutomaton):
        n = len(automaton.length)
        self.length = automaton.length
        # The parent within a segment's splay tree or, at its root, the state above the segment.
        self.parent = list(automaton.link)
        self.above, self.below = [-1] * n, [-1] * n
        self.colour = [-1] * n  # valid at the root of a splay tree, for the whole of it

    def _rotate(self, x: int, y: int, z: int) -> None:
        """Lifts ``x`` over its parent ``y``, whose parent is ``z``."""
        parent, above, below = self.parent, self.above, self.below
        if above[y] == x:
            moved = above[y] = below[x]
            below[x] = y
        else:
            moved = below[y] = above[x]
            above[x] = y
        if moved >= 0:
            parent[moved] = y
        parent[y], parent[x] = x, z
        if z >= 0:
            if above[z] == y:
                above[z] = x
            elif below[z] == y:
                below[z] = x

    def _splay(self, x: int) -> None:
        parent, above, below = self.parent, self.above, self.below
        while (y := parent[x]) >= 0 and (above[y] == x or below[y] == x):
            z = parent[y]
            if z < 0 or (above[z] != y and below[z] != y):
                self.colour[x] = self.colour[y]
                self._rotate(x, y, z)
                return
            top = parent[z]
            if top < 0 or (above[top] != z and below[top] != z):
                self.colour[x] = self.colour[z]
            if (above[y] == x) == (above[z] == y):
                self._rotate(y, z, top)
                self._rotate(x, y, parent[y])
            else:
                self._rotate(x, y, z)
                self._rotate(x, z, top)

    def access(self, state: int, colour: int) -> Iterator[tuple[int, int]]:
        """(last occurrence, longest length) of the old segments, longest first; recolours them.

        To be read to the end.
        """
        x, lower = state, -1
        while x >= 0:
            self._splay(x)
            old = self.colour[x]
            if old >= 0 and x:
                yield old, self.length[x]
            if (rest := self.below[x]) >= 0:
                self.colour[rest] = old
            self.below[x] = lower
            lower, x = x, self.parent[x]
        self._splay(state)
        self.colour[state] = colour


def runs_of(ids: list[int], min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of ``min_length`` words and two periods or more."""
    automaton = SuffixAutomaton(ids)
    seen, n, found, known = LastOccurrences(automaton), len(ids), [], {}
    for i, state in enumerate(automaton.prefix):
        for last, longest in seen.access(state, i):
            period = i - last
            if period > longest or known.get(period, -1) >= i:
                continue
            start, end = i - 2 * period + 1, i + 1
            while start and ids[start - 1] == ids[start - 1 + period]:
                start -= 1
            while end < n and ids[end] == ids[end - period]:
                end += 1
            known[period] = end - 1
            if end - start >= min_length:
                found.append((start, end - start, period))
    return found


def repeating_stretches(ids: np.ndarray, min_length: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of the stretches covered by sequences of ``min_length / 2`` words that occur
    again in the stretch; sequences are told apart by a hash, so a stretch may be wider than needed.
    """
    pending, gram = [(0, len(ids))], (min_length + 1) // 2
    while pending:
        begin, end = pending.pop()
        if end - begin < max(min_length, gram + 1):
            continue
        size = end - begin - gram + 1
        hashes = np.zeros(size, np.uint64)
        for j in range(gram):
            hashes = hashes * _BASE + ids[begin + j : begin + j + size]
        in_order = np.sort(hashes)
        twice = in_order[1:][in_order[1:] == in_order[:-1]]
        if not len(twice):
            continue
        marks = np.zeros(end - begin + 1, np.int64)
        at = np.flatnonzero(np.isin(hashes, twice))
        np.add.at(marks, at, 1)
        np.add.at(marks, at + gram, -1)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(marks) > 0]).astype(np.int8)))
        for low, high in edges.reshape(-1, 2):
            if high - low == end - begin:
                yield begin, end
            else:
                pending.append((begin + int(low), begin + int(high)))


def runs_of_words(words: list[bytes], min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """The runs of a text's words, by start, then period."""
    if len(words) < min_length:
        return []
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(word, len(numbers)) for word in words]
    found = []
    for begin, end in repeating_stretches(np.array(ids, np.uint64), min_length):
        runs = runs_of(ids[begin:end], min_length)
        found += [(begin + start, length, period) for start, length, period in runs]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by one space."""
    if not runs:
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        marks[start + period] += 1
        marks[start + length] -= 1
    keep = np.cumsum(marks[:-1]) == 0
    return b" ".join([word for word, kept in zip(words, keep) if kept])


_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))),
    ("collapsed", pa.binary()),
])
_SPARK = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed binary"
)


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the text without repeated periods.

    Words are what white space of ASCII separates, numbered from 0. Null counts as an empty text,
    which has no words and no runs; a text of fewer than ``min_length`` words has no runs. The time
    for a text grows with n log n for n words, the memory with n. Rows are worked on one by one,
    repeated ones alike; other columns are not looked at. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, left = [], [], []
            for text in batch.column(1):
                words = (text.as_py() or b"").split()  # of bytes: \x20 and \x09 to \x0D
                found = runs_of_words(words, min_length)
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                left.append(collapsed(words, found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, _ARROW.field("runs").type),
                 pa.array(left, pa.binary())],
                schema=_ARROW,
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, _SPARK).withColumn("collapsed", F.col("collapsed").cast("string"))
