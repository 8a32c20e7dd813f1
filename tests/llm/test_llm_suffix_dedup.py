"""Suffix arrays against sorting, and removal against all strings of all texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from transit_engine.llm import queries, suffix_array, suffix_dedup
from transit_engine.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("by_bucket", [True, False])
def test_suffix_array_and_prefixes(monkeypatch, by_bucket):
    monkeypatch.setattr(suffix_array, "SMALL_ALPHABET", 1024 if by_bucket else 0)
    rng = np.random.default_rng(by_bucket)
    for _ in range(400):
        letters = int(rng.integers(1, 5))
        text = np.append(rng.integers(1, letters + 1, rng.integers(0, 80)), 0)
        order = suffix_array.suffix_array(text, letters + 1)
        listed = text.tolist()
        expected = sorted(range(len(text)), key=lambda i: listed[i:])
        assert order.tolist() == expected
        before, length = suffix_array.permuted_prefixes(text, order, np.arange(len(text), 0, -1))
        for j, i in zip(expected, expected[1:]):
            common = next(k for k in range(len(text)) if listed[i + k : i + k + 1] != listed[j + k : j + k + 1])
            assert (before[i], length[i]) == (j, common)


def test_long_runs_of_one_letter():
    text = np.append(np.ones(20_000, np.int64), 0)
    assert suffix_array.suffix_array(text, 2).tolist() == list(range(20_000, -1, -1))


def by_definition(texts, min_bytes):
    """(n_bytes, n_removed, n_spans, hash of what is kept) of each text."""
    bodies = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + min_bytes] for b in bodies for i in range(len(b) - min_bytes + 1))
    found = []
    for body in bodies:
        gone = bytearray(len(body))
        upto = 0
        for i in range(len(body) - min_bytes + 1):
            if counts[body[i : i + min_bytes]] > 1:
                for k in range(max(i, upto), i + min_bytes):
                    gone[k] = 1
                upto = i + min_bytes
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = sum(g and not gone[k - 1] if k else g for k, g in enumerate(gone))
        found.append((len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def told(frame):
    removed = F.expr("aggregate(removed, 0L, (n, r) -> n + r.end - r.begin)")
    return frame.select("doc_id", "n_bytes", removed, F.size("removed"), F.sha2("kept", 256))


def check(spark, texts, min_bytes, crowd):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r[0]: tuple(r)[1:] for r in told(suffix_dedup.without_repeats(docs, min_bytes, crowd)).collect()}
    expected = by_definition(texts, min_bytes)
    assert [found[i] for i in range(len(texts))] == expected
    return expected


@pytest.mark.parametrize("crowd", [2, 200])
def test_removal_equals_definition(spark, crowd):
    """Copies, near copies, passages in many surroundings, repeats within a text, few letters."""
    rng = random.Random(crowd)

    def words(n):
        return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(n))

    texts = [words(rng.randint(0, 60)) for _ in range(20)]
    passage, other = words(15), words(9)
    texts += [words(rng.randint(0, 9)) + passage + words(rng.randint(0, 9)) for _ in range(30)]
    texts += [words(3) + passage[k : k + 60] + words(3) for k in range(0, 40, 3)]
    texts += [other + words(4) + other, texts[0], texts[0], texts[1] + "x", "a" * 300, "ab" * 100, "b" * 55]
    texts += ["a" * 39, "a" * 40, "", None, "\0" * 90, words(5) + "\0" * 50]
    expected = check(spark, texts, 40, crowd)
    assert sum(e[1] > 0 for e in expected) > 40


def test_strings_just_long_enough(spark):
    rng = random.Random(3)

    def letters(n):
        return "".join(rng.choice("abcdefghij ") for _ in range(n))

    shared, short = letters(400), letters(399)
    texts = [letters(50) + "1" + shared + "2" + letters(20), "3" + shared + "4", "5" + short + "6", "7" + short + "8",
             letters(3000), letters(399)]
    expected = check(spark, texts, 400, 200)
    assert [e[1] for e in expected] == [400, 400, 0, 0, 0, 0]


def test_long_text_is_cut_into_parts(spark, monkeypatch):
    """A window belongs to one part, wherever parts begin."""
    rng = random.Random(4)
    body = "".join(rng.choice("abcdefghij") for _ in range(5000))
    text = body + "!" + body[1234:2600] + "?"
    pieces = list(suffix_dedup.pieces_of(text.encode(), [len(text)], 400))
    assert sum(p[2] for p in pieces) == len(text) - 399
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    covered = []
    for _, offsets, data, ends in suffix_dedup._chunks([text.encode()], 400):
        begins = [0, *ends]
        for part, first, windows, *_ in suffix_dedup.pieces_of(data, ends, 400):
            at = offsets[part] + first - begins[part]
            covered += range(at, at + windows)
    assert sorted(covered) == list(range(len(text) - 399))


def test_edges(spark):
    same = "the same long text " * 3
    rows = [(1, None), (2, ""), (3, "short"), (4, same), (4, same), (None, same), (None, None), (5, "é" * 60)]
    extra = ["h", "k1", "k2", "body", "spans", "kept", "removed", "start", "g", "low", "p1", "whole", "a", "b", "half"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in extra})
    got = sorted(map(tuple, told(suffix_dedup.without_repeats(docs, 40)).collect()), key=repr)
    expected = by_definition([t for _, t in rows], 40)
    assert got == sorted(((i, *e) for (i, _), e in zip(rows, expected)), key=repr)
    assert suffix_dedup.without_repeats(docs.where("false"), 40).count() == 0


def test_query_over_whole_texts(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.registered()["op13_suffix_dedup"](spark, SF).collect()}
    expected = by_definition([d["text"] for d in docs], 400)
    assert [found[d["doc_id"]] for d in docs] == expected
