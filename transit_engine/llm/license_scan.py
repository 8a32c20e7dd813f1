"""Licence scans: parts of a text against licence templates by the Dice coefficient.

A text is looked at as a whole, by paragraphs, by lines, by sentences and by runs of neighbouring
sentences, whatever lines or paragraphs they belong to. Each becomes a set of bigrams of normalised
words. A template can only reach the wanted coefficient if two thirds of the bigrams of both are
shared, so runs are only looked at for the templates that the text as a whole shares so much with,
and only as far as one can still come near enough.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from transit_engine.llm.license_texts import TEMPLATES

MIN_DICE = 0.8
_WORDS = re.compile(r"[^\W_]+")
_PARAGRAPH = re.compile(r"\n[\x20\x09-\x0D]*\n")
_SENTENCE = re.compile(r"(?<=[.!?])[\x20\x09]+")


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters and digits, with the British spelling of licence as the other."""
    return _WORDS.findall(text.lower().replace("licence", "license"))


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


class Templates:
    """Bigram sets by size, and the templates that each bigram is in."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, min_dice: float = MIN_DICE):
        self.min_dice = min_dice
        self.sets = [(name, _bigrams(words_of(text))) for name, text in templates]
        self.index: dict[tuple[str, str], list[int]] = {}
        for k, (_, own) in enumerate(self.sets):
            for bigram in own:
                self.index.setdefault(bigram, []).append(k)
        # Dice reaches d only where min(m, n) / max(m, n) >= d / (2 - d), and only if as large a share
        # of either set is in both. The ratio is taken a little lower, as it is divided and multiplied by.
        self.ratio = min_dice / (2 - min_dice) - 1e-9
        self.smallest = min((len(s) for _, s in self.sets), default=0) * self.ratio

    def best(self, bigrams: set) -> tuple[float, str] | None:
        """The closest template that reaches the wanted coefficient; ties go to the first name."""
        n, found = len(bigrams), None
        inside = [b for b in bigrams if b in self.index]
        if len(inside) < n * self.ratio:
            return None
        for k, shared in self._shared(inside).items():
            name, own = self.sets[k]
            d = 2 * shared / (n + len(own))
            if d >= self.min_dice and (found is None or (-d, name) < (-found[0], found[1])):
                found = (d, name)
        return found

    def scan(self, text: str | None) -> tuple[str | None, float, int]:
        """Name and coefficient of the closest template, and the number of places that match one."""
        words, bounds, spans = _layout(text or "")
        pairs = list(zip(words, words[1:]))
        known = [p for p, pair in enumerate(pairs) if pair in self.index]
        if not known or len(known) < self.smallest:
            return None, 0.0, 0
        found, parts = [], []
        for i, j in spans:
            first, last = bounds[i], bounds[j] - 1
            if bisect_left(known, last) - bisect_left(known, first) < max(self.smallest, 1):
                continue
            if best := self.best(set(pairs[first:last])):
                found.append(best)
                parts.append((i, j))
        runs = self._runs(pairs, known, bounds)
        taken = np.zeros(len(bounds), bool)
        for i, j in parts:
            taken[i:j] = True
        matches = len(parts)
        for d, name, i, j in sorted(runs, key=lambda r: (-r[0], *r[1:])):
            found.append((d, name))
            if not taken[i:j].any():
                taken[i:j] = True
                matches += 1
        if not found:
            return None, 0.0, 0
        d, name = min(found, key=lambda f: (-f[0], f[1]))
        return name, d, matches

    def _shared(self, bigrams: Iterable) -> Counter:
        """How many of the bigrams each template has."""
        return Counter(chain.from_iterable(map(self.index.__getitem__, bigrams)))

    def _runs(
        self, pairs: list, known: list[int], bounds: list[int]
    ) -> Iterator[tuple[float, str, int, int]]:
        """Per template and first sentence, the run of sentences closest to the template, if near enough.

        A run begins with a sentence that shares a bigram with the template, as without another one
        it comes closer.
        """
        shared = self._shared({pairs[p] for p in known})
        near = [k for k, h in shared.items() if h >= len(self.sets[k][1]) * self.ratio]
        if not near:
            return
        previous, seen = np.empty(len(pairs), np.int64), {}
        for p, pair in enumerate(pairs):
            previous[p] = seen.get(pair, -1)
            seen[pair] = p
        at = np.array(bounds)
        for k in near:
            name, own = self.sets[k]
            m = len(own)
            hits = [p for p in known if pairs[p] in own]
            mine = np.zeros(len(pairs), bool)
            mine[hits] = True
            lasts = np.array(sorted({pairs[p]: p for p in hits}.values()))
            for i in np.unique(np.searchsorted(at, hits, "right") - 1).tolist():
                start = bounds[i]
                reach = len(lasts) - int(np.searchsorted(lasts, start))  # shared ones from here on
                # More bigrams than these that the template has not, and no run from here is near.
                spare = reach * (2 / self.min_dice - 1) - m + 1e-6
                if spare < 0:
                    continue
                size = 2 * m
                while True:
                    stop = bounds[min(int(np.searchsorted(at, start + size + 1)), len(at) - 1)] - 1
                    fresh = previous[start:stop] < start
                    n, h = np.cumsum(fresh), np.cumsum(fresh & mine[start:stop])
                    if stop == len(pairs) or h[-1] == reach or n[-1] - h[-1] > spare:
                        break
                    size *= 2
                ends = at[i + 1:] - 1 - start
                ends = ends[(ends > 0) & (ends <= len(n))]
                if len(ends):
                    d = 2 * h[ends - 1] / (n[ends - 1] + m)
                    e = int(d.argmax())
                    if d[e] >= self.min_dice:
                        j = int(np.searchsorted(at, start + ends[e] + 1))
                        yield float(d[e]), name, i, j


def _bigrams(words: list[str]) -> set:
    return set(zip(words, words[1:]))


def _layout(text: str) -> tuple[list[str], list[int], list[tuple[int, int]]]:
    """Words, where each sentence begins among them (and the end), and the parts as ranges of sentences.

    Parts are the sentences, lines and paragraphs and the whole; each once.
    """
    words: list[str] = []
    bounds, spans = [0], []
    paragraphs = _PARAGRAPH.split(text)
    for paragraph in paragraphs:
        before = len(bounds) - 1
        lines = paragraph.split("\n")
        for line in lines:
            first = len(bounds) - 1
            sentences = _SENTENCE.split(line)
            for sentence in sentences:
                if found := words_of(sentence):
                    words += found
                    spans.append((len(bounds) - 1, len(bounds)))
                    bounds.append(len(words))
            if len(sentences) > 1:
                spans.append((first, len(bounds) - 1))
        if len(lines) > 1:
            spans.append((before, len(bounds) - 1))
    if len(paragraphs) > 1:
        spans.append((0, len(bounds) - 1))
    return words, bounds, spans


def _parts(text: str) -> Iterator[list[str]]:
    """Words of the text, its paragraphs, lines and sentences; each part once."""
    words, bounds, spans = _layout(text)
    for i, j in spans:
        yield words[bounds[i]:bounds[j]]


def licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, min_dice: float = MIN_DICE
) -> DataFrame:
    """doc_id, license, dice, n_matches: one row per row of ``docs``.

    ``license`` is the closest template's name, null where no part of the text reaches ``min_dice``
    (null and empty texts, texts without words); ``n_matches`` counts the parts that do, and the closest
    runs that overlap neither them nor each other. Repeated rows are alike. Other columns are not looked at.
    """
    known = Templates(templates, min_dice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [known.scan(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([m[0] for m in made], pa.string()),
                    pa.array([m[1] for m in made], pa.float64()),
                    pa.array([m[2] for m in made], pa.int64()),
                ],
                names=["doc_id", "license", "dice", "n_matches"],
            )

    rows = docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
    return rows.mapInArrow(run, "doc_id long, license string, dice double, n_matches long")
