"""Removal of bytes that repeat: suffix arrays over shards of pieces that may share a string.

A byte goes if a string of ``min_bytes`` that covers it starts anywhere else too.

1. Every window of ``min_bytes`` picks an anchor, the 64-byte gram in it with the smallest hash, so
   equal windows pick equal anchors wherever they are. Consecutive windows with one anchor make a
   piece. What is written per piece is narrow: where it is, the hash of its anchor and of its bytes.
2. Windows can only be equal within the pieces of one anchor hash. Hashes are counted by an
   aggregate; those met once are done with, and those whose pieces are all the same bytes too.
3. Of the others one of each distinct piece is cut out of its text. A hash with more than ``CROWD``
   distinct pieces is split: a half takes the windows to the left, a half those to the right, and
   pieces that differ in what all windows of a half have in common part. Halving goes on while
   groups are crowded and ends at single windows, which are all equal or apart.
4. A shard is a mebibyte or somewhat more of whole groups. Its suffix array is sorted by inducing, permuted
   common prefixes of neighbours tell which windows occur twice.
5. Repeated windows go back to all places of their piece, and the covered bytes are cut out.

No task holds more than a shard, one group or one text. Places of pieces, which grow with the
input, stay in written tables. Hashes of pieces have 128 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transit_engine.llm.common import saved
from transit_engine.llm.suffix_array import permuted_prefixes, suffix_array

MIN_BYTES = 400
GRAM = 64
CHUNK = 1 << 20  # bytes of text looked at together
SHARD = 1 << 20  # bytes of pieces in one suffix array
CROWD = 200  # distinct pieces of a group
_PLACE_BITS = np.uint64((1 << 22) - 1)
_MIX = np.uint64(0x9FB21C651E98DF25)
KEY = ["k1", "k2"]
PIECE = ["p1", "p2"]


def gram_size(min_bytes: int) -> int:
    if min_bytes < 8:
        raise ValueError("strings of less than 8 bytes are not looked for")
    return min(GRAM, max(8, min_bytes // 16 * 8))


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """The hash of the gram at every place."""
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    n = len(data) - gram + 1
    hashed = np.zeros(n, np.uint64)
    for at in range(0, gram, 8):
        hashed ^= words[at : at + n]
        hashed *= _MIX
        hashed ^= hashed >> np.uint64(29)
    return hashed * _MIX


def anchor_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest hash among ``width`` from every place on, the first of a tie."""
    least = (hashes & ~_PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    n, reach = len(hashes) - width + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    return (np.minimum(least[:n], least[width - reach :][:n]) & _PLACE_BITS).astype(np.int64)


def pieces_of(data: bytes, ends: list[int], min_bytes: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, first window, number of windows, place of the anchor, its hash) of each piece
    of the texts that end at ``ends`` within ``data``."""
    if len(data) < min_bytes:
        return
    gram = gram_size(min_bytes)
    hashes = gram_hashes(data, gram)
    anchors = anchor_places(hashes, min_bytes - gram + 1)
    begins = np.array([0, *ends[:-1]])
    last = np.array(ends) - min_bytes  # the last window of each text
    usable = np.flatnonzero(last >= begins)
    # Where a text or an anchor begins; windows across texts are left out by their text's last one.
    change = np.zeros(len(anchors), bool)
    change[begins[usable]] = True
    change[1:] |= anchors[1:] != anchors[:-1]
    first = np.flatnonzero(change)
    text = np.searchsorted(begins[usable], first, side="right") - 1
    first, text = first[text >= 0], usable[text[text >= 0]]
    inside = first <= last[text]
    upto = np.minimum(np.append(first[1:], len(anchors)) - 1, last[text])
    first, text, upto = first[inside], text[inside], upto[inside]
    yield from zip(
        text.tolist(), first.tolist(), (upto - first + 1).tolist(), anchors[first].tolist(),
        hashes[anchors[first]].view(np.int64).tolist(),
    )


def _chunks(texts: list[bytes], min_bytes: int) -> Iterator[tuple[list[int], list[int], bytes, list[int]]]:
    """Texts put together up to ``CHUNK`` bytes, long ones cut so that each window is in one part:
    numbers of the texts, where the parts begin in them, the bytes, the ends."""
    numbers, offsets, parts, ends, held = [], [], [], [], 0
    for number, text in enumerate(texts):
        for begin in range(0, max(len(text) - min_bytes + 1, 0), CHUNK):
            part = text[begin : begin + CHUNK + min_bytes - 1]
            if held and held + len(part) > 2 * CHUNK:
                yield numbers, offsets, b"".join(parts), ends
                numbers, offsets, parts, ends, held = [], [], [], [], 0
            held += len(part)
            numbers.append(number)
            offsets.append(begin)
            parts.append(part)
            ends.append(held)
    if held:
        yield numbers, offsets, b"".join(parts), ends


def _halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


_PLACES = [("k1", "long"), ("k2", "long"), ("start", "long"), ("windows", "long"), ("rel", "long"),
           ("h", "long"), ("p1", "long"), ("p2", "long")]


def places(texts: DataFrame, min_bytes: int) -> DataFrame:
    """One row per piece of the texts (k1, k2, body): ``start`` and number of its ``windows``,
    ``rel`` from the anchor to the first window, hash ``h`` of the anchor, p1 and p2 of the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            bodies = batch.column(2).to_pylist()
            for numbers, offsets, data, ends in _chunks(bodies, min_bytes):
                begins, rows = [0, *ends], []
                for part, first, windows, anchor, hashed in pieces_of(data, ends, min_bytes):
                    piece = xxhash.xxh3_128_digest(data[first : first + windows + min_bytes - 1])
                    number = numbers[part]
                    rows.append((
                        k1[number], k2[number], offsets[part] + first - begins[part], windows,
                        first - anchor, hashed, *_halves(piece),
                    ))
                columns = zip(*rows) if rows else [[] for _ in _PLACES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=[n for n, _ in _PLACES]
                )

    return texts.select(*KEY, "body").mapInArrow(run, ", ".join(f"{n} {t}" for n, t in _PLACES))


_BODIES = "g long, p1 long, p2 long, low long, high long, whole boolean, body binary"


def _bodies(texts: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """The bytes of the wanted pieces; ``low`` and ``high`` are their windows from the anchor on."""
    per_text = wanted.groupBy(*KEY).agg(F.collect_list(F.struct(
        "h", *PIECE, "rel", "windows", "whole", "start"
    )).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for k1, k2, body, pieces in zip(*(batch.column(n) for n in ("k1", "k2", "body", "wanted"))):
                key = (k1.as_py(), k2.as_py())
                if key == before:
                    continue  # a repeated row
                before, body, rows = key, body.as_py(), []
                for p in pieces.as_py():
                    end = p["start"] + p["windows"] + min_bytes - 1
                    rows.append((
                        p["h"], p["p1"], p["p2"], p["rel"], p["rel"] + p["windows"] - 1, p["whole"],
                        body[p["start"] : end],
                    ))
                columns = list(zip(*rows))
                types = [pa.int64()] * 5 + [pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["g", "p1", "p2", "low", "high", "whole", "body"],
                )

    return texts.join(per_text, KEY).select(*KEY, "body", "wanted").mapInArrow(run, _BODIES)


def _open_groups(pieces: DataFrame) -> DataFrame:
    """g and the number ``m`` of its distinct pieces, where one of them may still hold what is
    not known to occur twice."""
    counted = pieces.groupBy("g").agg(
        F.count(F.lit(1)).alias("m"), F.count_if(~F.col("whole")).alias("unsettled")
    )
    return counted.where((F.col("m") > 1) & (F.col("unsettled") > 0)).select("g", "m")


def _halved(pieces: DataFrame, min_bytes: int) -> DataFrame:
    """Both halves of pieces whose windows lie in [a, b]; ``from1`` and ``from2`` are the piece that
    a half is of. Groups part by the bytes that all windows of the half have in common."""
    middle = F.expr("a + (b - a) div 2")
    sides = F.array(
        F.struct(F.col("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("b"))
    )
    rows = pieces.select("*", F.explode(sides).alias("half")).select(
        "g", F.col("p1").alias("from1"), F.col("p2").alias("from2"), "body", "half.a", "half.b",
        F.greatest("low", "half.a").alias("new_low"), F.least("high", "half.b").alias("new_high"),
        F.col("low").alias("begin"),
    ).where("new_low <= new_high")
    # Substrings of binary count from 1.
    body = F.substring("body", F.col("new_low") - F.col("begin") + 1, F.col("new_high") - F.col("new_low") + min_bytes)
    core = F.substring("body", F.col("b") - F.col("begin") + 1, min_bytes + F.col("a") - F.col("b"))
    return rows.select(
        F.xxhash64("g", "a", "b", core).alias("g"), "from1", "from2", "a", "b",
        F.col("new_low").alias("low"), F.col("new_high").alias("high"), body.alias("body"),
    ).select("*", F.xxhash64(F.lit(1), "body").alias("p1"), F.xxhash64("body", F.lit(2)).alias("p2"))


def repeated_windows(bodies: list[bytes], min_bytes: int) -> list[list[tuple[int, int]]]:
    """For each body the runs (first, last) of windows that start anywhere else among them too."""
    sizes = np.array([len(b) for b in bodies])
    ends = np.cumsum(sizes + 1)
    letters = np.empty(int(ends[-1]) + 1, np.int64)
    # 0 ends it all, 1 ends a body.
    letters[:-1] = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8).astype(np.int64) + 2
    letters[ends - 1] = 1
    letters[-1] = 0
    left = np.append(np.repeat(ends - 1, sizes + 1) - np.arange(int(ends[-1])), 0)
    before, length = permuted_prefixes(letters, suffix_array(letters, 258), left)
    twice = np.flatnonzero(length >= min_bytes)
    marked = np.zeros(len(letters), bool)
    marked[twice] = True
    marked[before[twice]] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    begins, found = ends - sizes - 1, [[] for _ in bodies]
    for first, end in edges.reshape(-1, 2).tolist():
        number = int(np.searchsorted(begins, first, side="right")) - 1
        found[number].append((first - int(begins[number]), end - 1 - int(begins[number])))
    return found


_MARKS = "p1 long, p2 long, low long, high long"


def _shard_marks(pieces: DataFrame, n_tasks: int, min_bytes: int) -> DataFrame:
    """Repeated windows of the pieces (from the anchor on), by one suffix array per shard."""

    def marks(held: list[tuple]) -> pa.RecordBatch:
        rows = []
        for (p1, p2, low, _), runs in zip(held, repeated_windows([h[3] for h in held], min_bytes)):
            rows += [(p1, p2, low + first, low + last) for first, last in runs]
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["p1", "p2", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for g, p1, p2, low, body in zip(*(batch.column(n).to_pylist() for n in ("g", "p1", "p2", "low", "body"))):
                if last == (g, p1, p2):
                    continue  # cut out of a repeated row
                if size >= SHARD and last[0] != g:
                    yield marks(held)
                    held, size = [], 0
                held.append((p1, p2, low, body))
                size += len(body)
                last = (g, p1, p2)
        if held:
            yield marks(held)

    return (
        pieces.repartition(n_tasks, "g")
        .sortWithinPartitions("g", *PIECE).mapInArrow(run, _MARKS)
    )


def _piece_marks(bodies: DataFrame, min_bytes: int, crowd: int) -> DataFrame:
    """Repeated windows of all pieces, crowded groups halved first."""
    lowest = -(min_bytes - gram_size(min_bytes))
    pieces = bodies.withColumn("a", F.lit(lowest).cast("long")).withColumn("b", F.lit(0).cast("long"))
    ready, maps, known = [], [], []
    while True:
        groups = saved(_open_groups(pieces), "suffix-groups")
        joined = pieces.join(groups, "g")
        # Pieces of a single window are all equal within their group.
        crowded = (F.col("m") > crowd) & (F.col("a") < F.col("b"))
        ready.append(joined.where(~crowded))
        if groups.where(F.col("m") > crowd).isEmpty():
            break
        halves = saved(_halved(joined.where(crowded), min_bytes), "suffix-halves")
        if halves.isEmpty():
            break
        maps.append(halves.select("from1", "from2", *PIECE))
        pieces = saved(
            halves.groupBy("g", *PIECE).agg(
                *[F.first(c).alias(c) for c in ("low", "high", "a", "b", "body")],
                (F.count(F.lit(1)) > 1).alias("whole"),
            ),
            "suffix-pieces",
        )
        known.append(pieces.where("whole").select(*PIECE, "low", "high"))
    columns = ["g", *PIECE, "low", "body"]
    todo = ready[0].select(*columns)
    for more in ready[1:]:
        todo = todo.unionByName(more.select(*columns))
    todo = saved(todo, "suffix-shards")
    size = todo.agg(F.sum(F.length("body"))).first()[0] or 0
    marks = saved(_shard_marks(todo, max(1, math.ceil(size / (8 * SHARD))), min_bytes), "suffix-marks")
    for halves, twice in zip(maps[::-1], known[::-1]):
        found = marks.unionByName(twice)
        up = found.join(halves, PIECE).select(F.col("from1").alias("p1"), F.col("from2").alias("p2"), "low", "high")
        marks = saved(marks.unionByName(up).distinct(), "suffix-marks")
    return marks


def repeats(texts: DataFrame, min_bytes: int = MIN_BYTES, crowd: int = CROWD) -> DataFrame:
    """k1, k2 and the set of ``spans`` (begin, end) to be removed, for texts that have any."""
    found = saved(places(texts, min_bytes), "suffix-places")
    counted = found.groupBy("h").agg(
        F.count(F.lit(1)).alias("n"),
        *[f(p).alias(f"{f.__name__}_{p}") for f in (F.min, F.max) for p in PIECE],
    ).where("n > 1")
    alike = (F.col("min_p1") == F.col("max_p1")) & (F.col("min_p2") == F.col("max_p2"))
    # Written before it is joined: a join right above an aggregate can't split a hot hash.
    shared = saved(counted.select("h", (~alike).alias("mixed")), "suffix-shared")
    hits = saved(found.join(shared, "h"), "suffix-hits")
    mixed = hits.where("mixed")
    distinct = saved(
        mixed.groupBy("h", *PIECE).agg(
            *[F.first(c).alias(c) for c in (*KEY, "start", "windows", "rel")],
            (F.count(F.lit(1)) > 1).alias("whole"),
        ),
        "suffix-distinct",
    )
    unsettled = saved(_open_groups(distinct.withColumnRenamed("h", "g")), "suffix-unsettled")
    wanted = distinct.join(unsettled.select(F.col("g").alias("h")), "h")
    bodies = saved(_bodies(texts, wanted, min_bytes), "suffix-bodies")
    marks = _piece_marks(bodies, min_bytes, crowd)
    whole = distinct.where("whole").select(
        *PIECE, F.col("rel").alias("low"), (F.col("rel") + F.col("windows") - 1).alias("high")
    )
    at = F.col("start") - F.col("rel")
    in_mixed = mixed.join(marks.unionByName(whole), PIECE).select(
        *KEY, (at + F.col("low")).alias("begin"), (at + F.col("high") + min_bytes).alias("end")
    )
    in_alike = hits.where("NOT mixed").select(
        *KEY, F.col("start").alias("begin"), (F.col("start") + F.col("windows") + min_bytes - 1).alias("end")
    )
    return in_mixed.unionByName(in_alike).groupBy(*KEY).agg(
        F.collect_set(F.struct("begin", "end")).alias("spans")
    )


def cut(body: bytes, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """The spans as maximal runs, and the bytes outside."""
    runs: list[list[int]] = []
    for begin, end in sorted(spans):
        if runs and begin <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([begin, end])
    at, kept = 0, []
    for begin, end in runs:
        kept.append(body[at:begin])
        at = end
    return [(b, e) for b, e in runs], b"".join([*kept, body[at:]])


_RUN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_RESULT = "doc_id long, n_bytes long, removed array<struct<begin: long, end: long>>, kept binary"


def without_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, the ``removed`` runs of bytes in order and the bytes ``kept``.

    Null counts as an empty text. Texts shorter than ``min_bytes`` keep everything. A row that is
    there twice is two texts, so both lose all that is long enough. Strings are judged on the texts
    as given, so no copy of a repeated string stays, and cuts may fall inside a character: what is
    kept are bytes. Long texts are looked at in parts of a mebibyte; one text and its spans have to
    fit in a task. An empty table gives no rows; other columns are not looked at.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"),
    ).select(
        "doc_id", "body", F.xxhash64("doc_id", "body").alias("k1"), F.xxhash64("body", "doc_id").alias("k2")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, left = [], [], []
            for body, spans in zip(batch.column(1), batch.column(2)):
                body = body.as_py()
                removed, kept = cut(body, [(s["begin"], s["end"]) for s in spans.as_py() or ()])
                sizes.append(len(body))
                runs.append([{"begin": b, "end": e} for b, e in removed])
                left.append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(left, pa.binary())],
                names=["doc_id", "n_bytes", "removed", "kept"],
            )

    found = saved(repeats(texts, min_bytes, crowd), "suffix-spans")
    return texts.join(found, KEY, "left").select("doc_id", "body", "spans").mapInArrow(run, _RESULT)
