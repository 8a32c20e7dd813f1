"""Runs against their definition, on random and planted words, and the query over whole texts."""

import hashlib
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from transit_engine.llm import periodic_runs, queries
from transit_engine.llm.common import table

SF = "/root/testdata/sf0.001"


def runs_by_definition(words, min_length):
    """Every period on its own: maximal stretches, kept if no smaller period fits them."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, 2 * q):
                part = words[i : i + length]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("min_length", [1, 2, 5, 12])
def test_runs_equal_their_definition(min_length):
    rng = random.Random(min_length)
    for _ in range(400):
        n, k = rng.randint(0, 70), rng.randint(1, 4)
        words = [b"%d" % rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.6:
            period, begin = rng.randint(1, max(1, n // 3)), rng.randrange(n)
            for i in range(begin + period, n - rng.randint(0, 3)):
                words[i] = words[i - period]
        assert periodic_runs.runs_of_words(words, min_length) == runs_by_definition(words, min_length)


def test_time_stays_near_linear():
    """Words that repeat in the worst ways: one word, two words at random, Fibonacci words."""
    a, b = [b"a"], [b"b"]
    while len(b) < 60_000:
        a, b = b, a + b
    rng = random.Random(1)
    texts = {
        "one": [b"a"] * 60_000, "two": [rng.choice((b"a", b"b")) for _ in range(60_000)], "fibonacci": b,
    }
    for name, words in texts.items():
        took = []
        for n in (15_000, 60_000):
            began = time.process_time()
            periodic_runs.runs_of_words(words[:n])
            took.append(time.process_time() - began)
        assert took[1] < 8 * max(took[0], 0.1), name


def expected(doc_id, text):
    """The query's row from its contract."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_definition(words, 12)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(),
    )


def test_query_over_whole_texts(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    short = {d["doc_id"]: d["text"] for d in docs if len((d["text"] or "").split()) < 700}
    found = {row["doc_id"]: tuple(row) for row in queries.registered()["op12_periodic_runs"](spark, SF).collect()}
    assert len(found) == len(docs) and len(short) > 0.8 * len(docs)
    assert all(found[i] == expected(i, text) for i, text in short.items())
    assert sum(row[1] > 0 for row in found.values()) >= 0.05 * len(docs)


def test_edges(spark):
    rows = [
        (1, None, "x"), (2, "", "x"), (3, " \n\x0b ", "x"), (4, "a " * 11, "x"), (5, "a " * 12, "x"),
        (5, "a " * 12, "x"), (None, "b c\t" * 20, "x"), (None, None, "x"), (14, "q w e r t y", "x"),
        (9, "no run in here", "x"), (10, "lorem ipsum dolor " * 60_000, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    planted = queries.with_planted_runs(docs)
    assert planted.count() == len(rows)
    found = periodic_runs.periodic_runs(docs).select("doc_id", "n_words", F.col("runs").cast("string"), "collapsed")
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == sorted([
        (1, 0, "[]", ""), (2, 0, "[]", ""), (3, 0, "[]", ""), (4, 11, "[]", " ".join("a" * 11)),
        (5, 12, "[{0, 12, 1}]", "a"), (5, 12, "[{0, 12, 1}]", "a"), (None, 20, "[{0, 20, 1}]", "b c"),
        (None, 0, "[]", ""), (14, 6, "[]", "q w e r t y"), (9, 4, "[]", "no run in here"),
        (10, 180_000, "[{0, 180000, 3}]", "lorem ipsum dolor"),
    ], key=repr)
    assert periodic_runs.periodic_runs(docs.where("false")).count() == 0
