"""SimHash near-duplicates by a binary trie self-join.

The distinct fingerprints are seen as the leaves of a binary trie. Pairs of nodes are traversed
together from the root: a pair has the number of bits in which its nodes differ, its children
inherit it, and a pair is given up once that number exceeds what it may spend.

At most 3 bits may differ, so one half of the fingerprint differs in at most 1. The trie is
therefore joined twice, once with either half first, and a pair may spend 1 bit within the first
half and 3 in all. That keeps the pairs per node in proportion to the depth, not to its cube.

The top of the trie is traversed by Spark: nodes of a depth that leaves a few thousand
fingerprints in each are paired, and pairs that are still too large go down step by step. Each
pair of subtrees is then finished in one task, with arrays. A task gives out the edges of a
spanning forest of the links it found, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.llm.common import saved, saved_narrow
from transit_engine.llm.components import components

SHINGLE = 3
MAX_BITS = 3
HALF_BITS = 1  # of one half at least, as 3 bits fall on two halves
HASH_SEED = 42
LEAF = 2048  # fingerprints a node should hold where tasks take over
STEP = 4  # trie levels that a pair goes down at a time
BITS = 64
AT_ONCE = 1 << 16
SMALL = 256  # pairs of fingerprints that are compared without going further down


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash, signed. A bit is set if it is in over half the shingle hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = ends - np.fromiter(map(len, words), np.int64, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_digest
    for k in range(0, len(starts), AT_ONCE):
        hashes = b"".join(
            [digest(joined[s:e], HASH_SEED) for s, e in zip(starts[k : k + AT_ONCE], ends[k : k + AT_ONCE])]
        )
        counts += _bit_counts(np.frombuffer(hashes, np.uint8).reshape(-1, 8))
    set_bits = np.packbits(counts * 2 > len(starts)).tobytes()
    return int.from_bytes(set_bits, "big", signed=True)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each bit is set, summed in bytes over blocks of 255 rows."""
    bits = np.unpackbits(hashes, axis=1)
    whole = len(bits) // 255 * 255
    blocks = bits[:whole].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8)
    return blocks.sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, text_key: one row per row of ``docs``; null and blank texts have fingerprint 0.

    ``text_key`` is a hash of the text, which tells rows of one doc_id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.int64()), batch.column(2)],
                names=["doc_id", "fp", "text_key"],
            )

    rows = docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text", "xxhash64(text) AS text_key")
    return rows.mapInArrow(run, "doc_id long, fp long, text_key long")


def _prefix(key: Column, depth: int) -> Column:
    """The node of a depth that a fingerprint lies in (a shift by 64 would do nothing)."""
    return F.shiftrightunsigned(key, BITS - depth) if depth else F.lit(0).cast("long")


def _budget(depth: int) -> int:
    return HALF_BITS if depth <= BITS // 2 else MAX_BITS


def _nodes(keys: DataFrame, depth: int) -> DataFrame:
    return keys.groupBy("half", _prefix(F.col("key"), depth).alias("node")).agg(
        F.count("*").alias("n")
    )


def _side(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select("half", F.col("node").alias(name), F.col("n").alias(f"n{name}"))


def subtree_pairs(keys: DataFrame, n: int, leaf: int = LEAF) -> list[tuple[int, DataFrame]]:
    """For some depths: the pairs of nodes (half, u, v, diff) to be finished by tasks.

    ``keys`` has (half, key), ``n`` keys for either half.
    """
    depth = min(BITS // 2, max(0, math.ceil(math.log2(max(n, 1) / leaf))))
    nodes = saved(_nodes(keys, depth), "trie-nodes")
    # All pairs of nodes at this depth within the budget: the same node, or one bit flipped.
    flips = F.array(*[F.lit(m).cast("long") for m in [0, *(1 << b for b in range(depth))]])
    pairs = (
        _side(nodes, "u").withColumn("flip", F.explode(flips))
        .withColumn("v", F.col("u").bitwiseXOR(F.col("flip"))).where("u <= v")
        .join(_side(nodes, "v"), ["half", "v"])
        .withColumn("diff", F.when(F.col("flip") == 0, 0).otherwise(1))
    )
    finished = []
    while True:
        pairs = saved(pairs.select("half", "u", "v", "nu", "nv", "diff"), "trie-pairs")
        large = (F.col("nu") + F.col("nv") > 3 * leaf) & F.lit(depth < BITS)
        finished.append((depth, pairs.where(~large)))
        pairs = pairs.where(large)
        if pairs.isEmpty():
            return finished
        below = min(depth + STEP, BITS // 2) if depth < BITS // 2 else min(depth + STEP, BITS)
        step = below - depth
        parents = pairs.select("half", F.explode(F.array("u", "v")).alias("parent")).distinct()
        parent = F.shiftrightunsigned("node", step)
        nodes = saved(
            _nodes(keys, below).withColumn("parent", parent)
            .join(parents, ["half", "parent"], "left_semi"),
            "trie-nodes",
        )
        down = pairs.select("half", F.col("u").alias("pu"), F.col("v").alias("pv"), "diff")
        for name in "uv":
            children = _side(nodes, name).withColumn(f"p{name}", F.shiftrightunsigned(name, step))
            down = down.join(children, ["half", f"p{name}"])
        spent = F.col("diff") + F.bit_count(
            F.col("u").bitwiseXOR(F.col("v")).bitwiseAND(F.lit((1 << step) - 1))
        )
        pairs = (
            down.where((F.col("pu") != F.col("pv")) | (F.col("u") <= F.col("v")))
            .withColumn("diff", spent.cast("int")).where(F.col("diff") <= _budget(below))
        )
        depth = below


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of nodes after the links (a, b).

    A label is the smallest node of its component, before and after; only these are hooked to each
    other, so that what earlier links have joined stays together.
    """
    while True:
        top_a, top_b = label[a], label[b]
        apart = top_a != top_b
        if not apart.any():
            return label
        a, b, top_a, top_b = a[apart], b[apart], top_a[apart], top_b[apart]
        label = label.copy()
        np.minimum.at(label, np.maximum(top_a, top_b), np.minimum(top_a, top_b))
        while not np.array_equal(label, further := label[label]):
            label = further


def spanning_edges(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component."""
    tip = np.flatnonzero(label != np.arange(len(label)))
    return tip, label[tip]


def _halves(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the second child of each node starts, for nodes given as ranges of sorted keys."""
    bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
    below = keys[lo] & ~(bit | (bit - np.uint64(1))) | bit
    return np.minimum(np.maximum(np.searchsorted(keys, below), lo), hi)


def _crossed(lo_a, hi_a, lo_b, hi_b):
    """All index pairs of small ranges."""
    wide = hi_b - lo_b
    counts = (hi_a - lo_a) * wide
    which = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    return lo_a[which] + at // wide[which], lo_b[which] + at % wide[which]


def join_subtrees(
    u: np.ndarray, v: np.ndarray | None, depth: int, diff: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between two sorted arrays of keys, or within one, below nodes of ``depth``.

    Traverses pairs of nodes. The frontier is taken in slices and links are given out slice by
    slice, so that memory doesn't depend on how many links there are.
    """
    same = v is None
    v = u if same else v
    if not len(u) or not len(v):
        return
    start = np.array([[0, len(u), 0, len(v), diff]], np.int64)
    stack = [(depth, start)]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > AT_ONCE:
            stack += [(depth, nodes[k : k + AT_ONCE]) for k in range(0, len(nodes), AT_ONCE)]
            continue
        work = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
        done = (work <= SMALL) | (depth == BITS)
        small = nodes[done]
        for k in range(0, len(small), AT_ONCE // 64):
            a, b = _crossed(*small[k : k + AT_ONCE // 64, :4].T)
            close = np.bitwise_count(u[a] ^ v[b]) <= MAX_BITS
            if same:
                close &= a < b
            yield a[close], b[close]
        nodes = nodes[~done]
        if not len(nodes):
            continue
        lo_a, hi_a, lo_b, hi_b, spent = nodes.T
        mid_a, mid_b = _halves(u, lo_a, hi_a, depth), _halves(v, lo_b, hi_b, depth)
        children = np.concatenate([
            np.stack([lo_a, mid_a, lo_b, mid_b, spent], 1),
            np.stack([mid_a, hi_a, mid_b, hi_b, spent], 1),
            np.stack([lo_a, mid_a, mid_b, hi_b, spent + 1], 1),
            # Of a node with itself, one crossing is enough.
            np.stack([mid_a, hi_a, lo_b, mid_b, spent + 1], 1)[~((lo_a == lo_b) & same)],
        ])
        alive = (children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3])
        alive &= children[:, 4] <= _budget(depth + 1)
        stack.append((depth + 1, children[alive]))


def _finish(key: tuple, table: pa.Table) -> pa.Table:
    """Joins one pair of subtrees; gives edges between fingerprints."""
    depth, diff = key[1].as_py(), table.column("diff")[0].as_py()
    half, u_is_v = key[0].as_py(), key[2].as_py() == key[3].as_py()
    keys = table.column("key").to_numpy().view(np.uint64)
    of_v = table.column("of_v").to_numpy(zero_copy_only=False)
    u, v = np.sort(keys[~of_v]), np.sort(keys[of_v])
    both = u if u_is_v else np.concatenate([u, v])
    label = np.arange(len(both))
    for a, b in join_subtrees(u, None if u_is_v else v, depth, diff):
        label = merged(label, a, b if u_is_v else b + len(u))
    a, b = spanning_edges(label)
    if half:
        both = (both << np.uint64(BITS // 2)) | (both >> np.uint64(BITS // 2))
    both = both.view(np.int64)
    return pa.table({"a": pa.array(both[a], pa.int64()), "b": pa.array(both[b], pa.int64())})


def fingerprint_edges(distinct: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Edges (a, b) that connect the fingerprints as all links of at most 3 bits would."""
    turned = F.shiftleft("fp", BITS // 2).bitwiseOR(F.shiftrightunsigned("fp", BITS // 2))
    keys = distinct.select(F.lit(0).alias("half"), F.col("fp").alias("key")).union(
        distinct.select(F.lit(1), turned)
    )
    work = None
    for depth, pairs in subtree_pairs(keys, distinct.count(), leaf):
        placed = keys.withColumn("node", _prefix(F.col("key"), depth))
        for of_v, name in enumerate("uv"):
            chosen = pairs if not of_v else pairs.where("u <> v")
            rows = placed.join(
                chosen.withColumn("node", F.col(name)).select("half", "node", "u", "v", "diff"),
                ["half", "node"],
            ).select(
                "half", F.lit(depth).alias("depth"), "u", "v", "diff", "key",
                F.lit(bool(of_v)).alias("of_v"),
            )
            work = rows if work is None else work.union(rows)
    return work.groupBy("half", "depth", "u", "v").applyInArrow(_finish, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, leaf: int = LEAF) -> DataFrame:
    """doc_id, fp, text_key, component_id: one row per row of ``docs``.

    Texts are lower-cased (A-Z), cut into words and shingles of ``shingle`` words, repeats
    included; fewer words are one shingle, none give fingerprint 0, which is linked like any
    other. ``component_id`` is the smallest doc_id that links of at most 3 differing bits reach;
    rows without doc_id are linked but never name a component (null if all of it lacks one).
    Repeated rows are alike. Other columns are not looked at; an empty table gives an empty result.
    """
    prints = saved(fingerprints(docs, shingle), "fingerprints")
    distinct = saved_narrow(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints",
        prints.count(),
    )
    roots = components(fingerprint_edges(distinct, leaf))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = saved_narrow(
        named.join(smallest, "root").select("fp", "component_id"), "fingerprint-groups", distinct.count()
    )
    return prints.join(found, "fp").select("doc_id", "fp", "text_key", "component_id")


def survivors(docs: DataFrame) -> DataFrame:
    """One document of each group: the row with the smallest doc_id and, of several texts with that
    id, the one with the smallest key. Rows without doc_id can't be told apart by it and stay; rows
    that repeat both doc_id and text stay or go together, rows that share an id only do not."""
    found = saved(near_duplicates(docs).where(F.col("doc_id").isNotNull()), "fingerprint-rows")
    named = found.where(F.col("doc_id") == F.col("component_id"))
    several = named.groupBy("component_id").agg(
        F.min("text_key").alias("first"), F.max("text_key").alias("last")
    ).where(F.col("first") != F.col("last"))
    others = named.join(several, "component_id").where(F.col("text_key") != F.col("first"))
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id", "text_key").unionByName(
        others.select("doc_id", "text_key")
    ).distinct().toDF("gone_id", "gone_key")
    # A row travels as one struct, so that none of its columns can clash.
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("row_id"),
        F.xxhash64("text").alias("row_key"),
    )
    same = (F.col("row_id") == F.col("gone_id")) & (F.col("row_key") == F.col("gone_key"))
    return rows.join(gone, same, "left_anti").select("row.*")
