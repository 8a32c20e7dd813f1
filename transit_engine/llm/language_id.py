"""Language identification by interpolated Kneser-Ney character models.

A model is fitted per language on a bounded number of labelled documents. The counts of all
languages share sorted arrays of n-gram hashes, one per order, with a column of log probabilities
per language; another set of arrays has the log weights with which a context backs off. A text is
read once: each position looks its longest n-gram up, and only positions without one go down an
order. The language of the lowest cross-entropy per character wins; whether it is accepted is
decided by limits calibrated on labelled documents that the counts have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transit_engine.llm.common import broadcast_bounded, saved

ORDER = 4
MAX_PER_LANGUAGE = 1000  # labelled documents of each language that the model is fitted on
CALIBRATION = 5  # one in so many of them sets the limits instead
BATCH = 1 << 19  # characters looked at together
UNDETERMINED = "und"
NO_LETTER = 0x20
REJECTED_SHARE = 0.005  # of calibration documents that the limit of a language may turn away
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_FOLDED: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """For every code point its lower case, or a blank for what is no letter."""
    if not _FOLDED:
        table = np.full(0x110000, NO_LETTER, np.uint32)
        for c in range(0x110000):
            if (s := chr(c)).isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLDED.append(table)
    return _FOLDED[0]


def characters(text: str | None) -> np.ndarray:
    """The letters in lower case, one blank for what lies between; empty without a letter.

    Starts with a blank, so that the first letter has a context.
    """
    raw = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    folded = _folded()[raw]
    blank = folded == NO_LETTER
    if blank.all():
        return np.zeros(0, np.uint32)
    keep = np.ones(len(folded), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[0] = not blank[0]
    return np.concatenate([np.array([NO_LETTER], np.uint32), folded[keep]])


def gram_hashes(codes: np.ndarray, longest: int) -> list[np.ndarray]:
    """Entry k-1: for each position the hash of the k characters that end there."""
    letters = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    letters ^= letters >> np.uint64(32)
    hashes = [letters]
    for _ in range(1, longest):
        longer = letters.copy()
        longer[1:] += hashes[-1][:-1] * MULTIPLIER
        hashes.append(longer)
    return hashes


@dataclass
class LanguageModel:
    """Arrays of all languages; ``grams[k]`` and ``logs[k]`` have order k+1, ``contexts[k]`` and
    ``backoff[k]`` the contexts of k characters that they follow."""

    languages: list[str]
    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    uniform: float
    limits: np.ndarray = field(default_factory=lambda: np.zeros(0))
    sharpness: float = 50.0

    def n_bytes(self) -> int:
        return sum(a.nbytes for part in (self.grams, self.logs, self.contexts, self.backoff) for a in part)

    def log_probabilities(self, hashes: list[np.ndarray], depth: np.ndarray) -> np.ndarray:
        """log2 of each position's character under each language; ``depth`` is the number of
        characters that come before it in its text."""
        result = np.zeros((len(depth), len(self.languages)), np.float32)
        left = np.arange(len(depth))
        for order in range(len(self.grams), 0, -1):
            able = depth[left] >= order - 1
            at, found = _lookup(self.grams[order - 1], hashes[order - 1][left])
            found &= able
            result[left[found]] += self.logs[order - 1][at[found]]
            left, able = left[~found], able[~found]
            if order > 1 and len(left):
                # What the context gives to shorter n-grams; contexts never seen give all.
                before = hashes[order - 2][np.maximum(left - 1, 0)]
                at, found = _lookup(self.contexts[order - 1], before)
                found &= able
                result[left[found]] += self.backoff[order - 1][at[found]]
        result[left] += self.backoff[0][0] + self.uniform
        return result

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy per character of each text (not empty) under each language.

        A long text is read in pieces, each with the context that its first characters need.
        """
        sums = np.zeros((len(texts), len(self.languages)))
        pieces, size = [], 0
        for i, codes in enumerate(texts):
            # The blank put before a text isn't scored.
            for start in range(1, max(len(codes), 2), BATCH):
                context = min(start, len(self.grams) - 1)
                piece = codes[start - context : start + BATCH]
                pieces.append((i, piece, context))
                size += len(piece)
                if size >= BATCH:
                    self._add(sums, pieces)
                    pieces, size = [], 0
        if pieces:
            self._add(sums, pieces)
        lengths = np.array([max(len(codes) - 1, 1) for codes in texts])
        return -sums / lengths[:, None]

    def _add(self, sums: np.ndarray, pieces: list[tuple[int, np.ndarray, int]]) -> None:
        starts = np.cumsum([0, *(len(p) for _, p, _ in pieces)])
        depth = np.arange(starts[-1]) - np.repeat(starts[:-1], np.diff(starts))
        hashes = gram_hashes(np.concatenate([p for _, p, _ in pieces]), len(self.grams))
        logs = self.log_probabilities(hashes, depth)
        logs[depth < np.repeat([c for _, _, c in pieces], np.diff(starts))] = 0
        np.add.at(
            sums, [i for i, _, _ in pieces],
            np.add.reduceat(logs, starts[:-1], axis=0, dtype=np.float64),
        )


def _lookup(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def kneser_ney(languages: list[str], counts: dict[str, dict[tuple[int, ...], int]], order: int) -> LanguageModel:
    """The model from counts of n-grams of ``order`` characters per language.

    Lower orders count in how many contexts an n-gram was seen. Each order is interpolated with
    the next lower one, the first with the uniform distribution over the characters seen.
    """
    alphabet = {g[-1] for c in counts.values() for g in c}
    uniform = 1.0 / (len(alphabet) + 1)
    per_order: list[list[dict]] = [[] for _ in range(order)]
    for language in languages:
        current = counts.get(language, {})
        for k in range(order, 0, -1):
            per_order[k - 1].append(current)
            shorter: dict[tuple[int, ...], int] = {}
            for gram in current:
                shorter[gram[1:]] = shorter.get(gram[1:], 0) + 1
            current = shorter
    model = LanguageModel(languages, [], [], [], [], float(np.log2(uniform)))
    lower: dict[tuple[int, ...], np.ndarray] = {}
    for k in range(1, order + 1):
        grams = sorted(set().union(*per_order[k - 1]))
        contexts = sorted({g[:-1] for g in grams})
        place = {c: i for i, c in enumerate(contexts)}
        spread = np.ones((len(contexts), len(languages)))
        seen = np.zeros((len(grams), len(languages)))
        of = np.array([place[g[:-1]] for g in grams], np.int64)
        for j, table in enumerate(per_order[k - 1]):
            values = np.array([table.get(g, 0) for g in grams], float)
            once, twice = (values == 1).sum(), (values == 2).sum()
            discount = once / (once + 2 * twice) if once else 0.5
            totals = np.bincount(of, values, len(contexts))
            kinds = np.bincount(of, values > 0, len(contexts))
            known = totals > 0
            spread[known, j] = np.minimum(discount * kinds[known] / totals[known], 1.0)
            seen[:, j] = np.maximum(values - discount, 0) / np.maximum(totals[of], 1)
        if k == 1:
            base = np.full((len(grams), len(languages)), uniform)
        else:
            base = np.stack([lower[g[1:]] for g in grams])
        p = seen + spread[of] * base
        lower = dict(zip(grams, p))
        _store(model, grams, np.log2(p), contexts, np.log2(np.maximum(spread, 1e-9)))
    return model


def _store(model: LanguageModel, grams, logs, contexts, backoff) -> None:
    def hashes(keys) -> np.ndarray:
        k = len(keys[0])
        if not k:
            return np.zeros(1, np.uint64)
        codes = np.array(keys, np.uint32)
        return gram_hashes(codes.ravel(), k)[k - 1].reshape(-1, k)[:, -1]

    for keys, values, arrays, columns in (
        (grams, logs, model.grams, model.logs), (contexts, backoff, model.contexts, model.backoff)
    ):
        hashed = hashes(keys)
        order = np.argsort(hashed)
        arrays.append(hashed[order])
        columns.append(values[order].astype(np.float32))


def calibrated(model: LanguageModel, texts: list[np.ndarray], truth: list[str]) -> LanguageModel:
    """Sets the cross-entropy above which a language is not accepted, and the sharpness with which
    differences become a probability, by texts of known language."""
    n = len(model.languages)
    model.limits = np.full(n, np.inf)
    if not texts:
        return model
    entropies = model.entropies(texts)
    true = np.array([model.languages.index(t) for t in truth])
    for j in range(n):
        own = entropies[true == j, j]
        if len(own):
            model.limits[j] = np.quantile(own, 1 - REJECTED_SHARE) * 1.05
    gaps = entropies - entropies[np.arange(len(true)), true][:, None]
    best = (np.inf, model.sharpness)
    for sharpness in (1.0, 2.0, 5.0, 10.0, 20.0, 50.0):
        loss = np.log1p(np.exp2(np.clip(-sharpness * gaps, -60, 60)).sum(axis=1) - 1).mean()
        best = min(best, (round(loss, 3), sharpness))  # the least sharp that is as good
    model.sharpness = best[1]
    return model


def training_rows(docs: DataFrame, per_language: int = MAX_PER_LANGUAGE) -> DataFrame:
    """lang, text, part of at most so many documents of each language, those of the lowest hashes.

    Ids are chosen first, so that no text is sorted; ``part`` 0 is for calibration. Of a large
    language only ids with low hashes, about four times as many as are wanted, are ranked.
    """
    named = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select(
        "lang", "doc_id", F.shiftrightunsigned(F.xxhash64("doc_id"), 1).alias("drawn")
    )
    counts = saved(named.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    low = F.col("drawn") < F.lit(float(1 << 63)) * (4 * per_language) / F.col("n")
    order = Window.partitionBy("lang").orderBy("drawn", "doc_id")
    ids = (
        named.join(counts, "lang").where(low)
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
    )
    chosen = saved(ids.select("lang", "doc_id", (F.col("place") % CALIBRATION).alias("part")), "language-sample")
    return docs.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"]).select(
        "lang", "text", "part"
    )


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = characters(text)
                if len(codes) < order:
                    continue
                windows = np.lib.stride_tricks.sliding_window_view(codes, order)
                for gram, n in zip(*np.unique(windows, axis=0, return_counts=True)):
                    key = (lang, gram.astype("<u4").tobytes().decode("utf-32-le"))
                    rows[key] = rows.get(key, 0) + int(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in rows], pa.string()),
                    pa.array([k[1] for k in rows], pa.string()), pa.array(rows.values(), pa.int64()),
                ],
                names=["lang", "gram", "n"],
            )

    return run


def train(docs: DataFrame, order: int = ORDER, per_language: int = MAX_PER_LANGUAGE) -> LanguageModel | None:
    """A model of the non-null ``lang`` values of ``docs``; None if there is none to learn.

    Counts are made by Spark. What reaches the driver is bounded by ``per_language``.
    """
    rows = saved(training_rows(docs, per_language), "language-rows")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return None
    held = rows.where(F.col("part") == 0)
    # With very few documents all of them count.
    counted = rows.where(F.col("part") != 0) if rows.count() >= 4 * CALIBRATION else rows
    grams = (
        counted.select("lang", "text").mapInArrow(_count(order), "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    counts: dict[str, dict[tuple[int, ...], int]] = {}
    for r in grams.collect():
        counts.setdefault(r["lang"], {})[tuple(map(ord, r["gram"]))] = r["n"]
    if not counts:
        return None
    model = kneser_ney(languages, counts, order)
    known = [(characters(r["text"]), r["lang"]) for r in held.select("lang", "text").collect()]
    known = [k for k in known if len(k[0]) > 1]
    return calibrated(model, [k[0] for k in known], [k[1] for k in known])


SCORED = pa.schema([
    ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
    ("cross_entropy", pa.float64()), ("accepted", pa.bool_()),
])


def identified(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, accepted: one row per row of ``docs``.

    ``lang_pred`` is the best language, ``und`` where the text is null or has no letter, or where
    there is no model; then score is 0, the cross-entropy null and ``accepted`` false. ``accepted``
    is false too where the text fits its best language worse than calibration allows: a user who
    wants rejection reads ``lang_pred`` only where it is true. Ties go to the first language by
    name. Only doc_id and text are looked at; repeated rows are alike.
    """
    rows = docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
    if model is None:
        return rows.select(
            "doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("cross_entropy"), F.lit(False).alias("accepted"),
        )
    sent = broadcast_bounded(docs.sparkSession, model, model.n_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            n = batch.num_rows
            names, score = [UNDETERMINED] * n, np.zeros(n)
            entropy, accepted = [None] * n, np.zeros(n, bool)
            for part in _slices(batch.column(1)):
                rates = known.entropies([codes for _, codes in part])
                best = rates.argmin(axis=1)
                gaps = rates - rates[np.arange(len(part)), best][:, None]
                sure = 1 / np.exp2(-known.sharpness * gaps).sum(axis=1)
                for (i, _), j, s, h in zip(part, best, sure, rates):
                    names[i], score[i], entropy[i] = known.languages[j], s, float(h[j])
                    accepted[i] = h[j] <= known.limits[j]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(names, pa.string()), pa.array(score),
                    pa.array(entropy, pa.float64()), pa.array(accepted),
                ],
                schema=SCORED,
            )

    return rows.mapInArrow(
        run, "doc_id long, lang_pred string, score double, cross_entropy double, accepted boolean"
    )


def _slices(texts: pa.Array) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Texts with letters, in lists of about ``BATCH`` characters."""
    part, size = [], 0
    for i, text in enumerate(texts):
        codes = characters(text.as_py())
        if len(codes) > 1:
            part.append((i, codes))
            size += len(codes)
        if size >= BATCH:
            yield part
            part, size = [], 0
    if part:
        yield part
