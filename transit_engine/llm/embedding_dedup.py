"""Near-duplicate embeddings by spherical-cap filters.

Filters are directions; a vector passes those with which its inner product is high. The directions
are structured: the space is turned and cut into blocks, every block has a code of random
directions, and a filter is one word of each code put together. A vector's filters are listed by
decoding the codes block by block, dropping what can't reach the threshold any more, so that many
filters cost little. Vectors that share a filter are compared in full; close ones share one with
high probability (``tests/llm`` measure the recall against brute force).

Equal vectors are one to the index. A filter that many vectors pass is cut into parts, and every
pair of parts is a block of its own, so no task gets more than two parts. A link is counted in the
first filter that both vectors share; a block gives out numbers of links and a spanning forest,
never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transit_engine.llm.common import broadcast_bounded, saved
from transit_engine.llm.components import components
from transit_engine.llm.simhash import merged

MIN_COSINE = 0.9
PER_VECTOR = 32  # filters a vector passes on average
PER_FILTER = 12  # vectors that pass a filter on average
PART = 256  # vectors of one filter in a block
SAMPLE = 2000  # vectors that the threshold is fitted on
MAX_WORDS = 1024  # of a code; more filters take more blocks
AT_ONCE = 1 << 14
SEED = 11


@dataclass
class Filters:
    """The codes of one dimension and the threshold for passing a filter."""

    turn: np.ndarray
    blocks: list[np.ndarray]
    words: int
    threshold: float = 0.0

    @classmethod
    def make(cls, dimension: int, n: int, seed: int = SEED) -> Filters:
        """Codes for ``n`` vectors: as many filters as keep ``PER_FILTER`` vectors in each."""
        rng = np.random.default_rng([seed, dimension])
        wanted = max(n * PER_VECTOR / PER_FILTER, 64.0)
        count = max(2, math.ceil(math.log(wanted) / math.log(MAX_WORDS)))
        if dimension < 4 * count:  # too few components to be cut
            count = 1
        words = math.ceil(wanted ** (1 / count))
        turn = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
        blocks = []
        for size in (len(part) for part in np.array_split(np.arange(dimension), count)):
            code = rng.standard_normal((words, size))
            blocks.append(code / np.linalg.norm(code, axis=1, keepdims=True) / math.sqrt(count))
        return cls(turn, blocks, words)

    def n_bytes(self) -> int:
        return self.turn.nbytes + sum(b.nbytes for b in self.blocks)

    def scores(self, units: np.ndarray) -> list[np.ndarray]:
        turned, at, result = units @ self.turn, 0, []
        for block in self.blocks:
            result.append(turned[:, at : at + block.shape[1]] @ block.T)
            at += block.shape[1]
        return result

    def decode(self, scores: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the filters of one vector that reach the threshold, by number."""
        best = [s.max() for s in scores]
        number, total = np.zeros(1, np.int64), np.zeros(1)
        for k, score in enumerate(scores):
            reached = total[:, None] + score[None]
            row, word = np.nonzero(reached + sum(best[k + 1 :]) >= threshold)
            number, total = number[row] * self.words + word, reached[row, word]
        return number, total

    def fit(self, units: np.ndarray, per_vector: int = PER_VECTOR) -> Filters:
        """Sets the threshold at which the sampled vectors pass ``per_vector`` filters each."""
        reached = []
        for k in range(len(units)):
            scores = self.scores(units[k : k + 1])
            # Start high and go down until there are some more than are asked for on average.
            floor = sum(s.max() for s in scores)
            while True:
                floor -= 0.07 * max(abs(floor), 1e-3)
                found = self.decode([s[0] for s in scores], floor)[1]
                if len(found) >= 4 * per_vector or len(found) == self.words ** len(self.blocks):
                    break
            reached.append(np.sort(found)[::-1][: 4 * per_vector])
        values = np.sort(np.concatenate(reached))[::-1]
        self.threshold = float(values[min(len(values), per_vector * len(units)) - 1])
        return self


def unit(vector) -> np.ndarray | None:
    """The vector at length 1, or None for one that links with nothing."""
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    values = np.asarray(vector, np.float64)
    if not np.isfinite(values).all() or not (largest := np.abs(values).max()):
        return None
    values = values / largest
    return values / np.linalg.norm(values)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [unit(v.as_py()) for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array([None if u is None else len(u) for u in made], pa.int32()),
                pa.array([None if u is None else u.tobytes() for u in made], pa.binary()),
            ],
            names=["vec_id", "dimension", "unit"],
        )


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dimension)


def _listed(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = sent.value
        for batch in batches:
            made = []
            units = _matrix(batch.column(1), len(filters.turn))
            for k in range(0, len(units), 512):
                scores = filters.scores(units[k : k + 512])
                for i in range(len(scores[0])):
                    made.append(filters.decode([s[i] for s in scores], filters.threshold)[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.list_(pa.int64()))], names=["uid", "filters"]
            )

    return run


def _share_earlier(filters: list[np.ndarray], a: np.ndarray, b: np.ndarray, this: int) -> np.ndarray:
    """Whether the vectors of each pair share a filter before ``this``."""
    before = [f[f < this] for f in filters]
    used = np.unique(np.concatenate([a, b]))
    sizes = np.array([len(before[i]) for i in used])
    owner = np.repeat(used, sizes)
    numbers = np.concatenate([before[i] for i in used]) if len(used) else np.zeros(0, np.int64)
    _, number = np.unique(numbers, return_inverse=True)
    words = -(-(int(number.max()) + 1 if len(number) else 1) // 64)
    bits = np.zeros((len(filters), words), np.uint64)
    np.bitwise_or.at(bits, (owner, number // 64), np.uint64(1) << (number % 64).astype(np.uint64))
    result = np.zeros(len(a), bool)
    for k in range(0, len(a), AT_ONCE):
        s = slice(k, k + AT_ONCE)
        result[s] = (bits[a[s]] & bits[b[s]]).any(axis=1)
    return result


def _compare(min_cosine: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        this, crossing = key[0].as_py(), key[1].as_py() != key[2].as_py()
        uids, sizes = table.column("uid").to_numpy(), table.column("size").to_numpy()
        second = table.column("part").to_numpy() == key[2].as_py()
        units = _matrix(table.column("unit"), len(table.column("unit")[0].as_py()) // 8)
        close = units @ units.T >= min_cosine
        if crossing:
            close &= ~second[:, None] & second[None, :]
        else:
            close = np.triu(close, 1)
        a, b = np.nonzero(close)
        filters = [np.asarray(f, np.int64) for f in table.column("filters").to_pylist()] if len(a) else []
        first = ~_share_earlier(filters, a, b, this) if len(a) else np.zeros(0, bool)
        links = np.bincount(a[first], sizes[b[first]], len(uids))
        links = (links + np.bincount(b[first], sizes[a[first]], len(uids))).astype(np.int64)
        top = merged(np.arange(len(uids)), a, b)
        told = np.flatnonzero((links > 0) | (top != np.arange(len(uids))))
        return pa.table({
            "uid": pa.array(uids[told], pa.int64()), "links": pa.array(links[told], pa.int64()),
            "root": pa.array(uids[top[told]], pa.int64()),
        })

    return run


def filter_index(distinct: DataFrame, dimension: int, n: int) -> DataFrame:
    """uid, filters of every vector of one dimension (all are indexed, a sample sets the threshold)."""
    filters = Filters.make(dimension, n)
    sample = distinct.orderBy(F.xxhash64("unit"), "uid").limit(SAMPLE).select("unit").collect()
    filters.fit(np.stack([np.frombuffer(r["unit"]) for r in sample]))
    sent = broadcast_bounded(distinct.sparkSession, filters, filters.n_bytes())
    return distinct.select("uid", "unit").mapInArrow(_listed(sent), "uid long, filters array<long>")


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty or zero, or hold a null or non-finite component, link with nothing,
    nor do vectors of different dimensions; such rows are components of their own. ``n_links``
    counts the other rows with a cosine of at least ``min_cosine``, equal vectors included.
    ``component_id`` is the smallest vec_id that links reach; rows without vec_id are linked but
    name no component. Rows that repeat a vec_id are rows of their own and link to each other.
    Labels and other columns are not looked at. An empty table gives an empty result.
    """
    rows = vectors.selectExpr("cast(vec_id as bigint) AS vec_id", "embedding")
    units = saved(rows.mapInArrow(_units, "vec_id long, dimension int, unit binary"), "unit-vectors")
    distinct = saved(
        units.where(F.col("unit").isNotNull()).groupBy("dimension", "unit")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("size"))
        .withColumn("uid", F.monotonically_increasing_id()),
        "distinct-vectors",
    )
    found = None
    # A table has few dimensions, mostly one; each has codes of its own.
    for dimension, n in sorted((r[0], r[1]) for r in distinct.groupBy("dimension").count().collect()):
        own = distinct.where(F.col("dimension") == dimension)
        part = _linked(own, saved(filter_index(own, dimension, n), "vector-filters"), min_cosine)
        found = part if found is None else found.union(part)
    if found is None:
        return _alone(units)
    blocks = saved(found, "vector-links")
    links = blocks.groupBy("uid").agg(F.sum("links").alias("links"))
    roots = components(blocks.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    named = distinct.join(links, "uid", "left").join(
        roots.withColumnRenamed("node", "uid"), "uid", "left"
    ).withColumn("root", F.coalesce("root", "uid"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = saved(
        named.join(smallest, "root").select(
            "dimension", "unit", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            "component_id",
        ),
        "vector-groups",
    )
    usable = units.where(F.col("unit").isNotNull()).join(groups, ["dimension", "unit"])
    return _told(usable).unionByName(_alone(units.where(F.col("unit").isNull())))


def _told(rows: DataFrame) -> DataFrame:
    return rows.select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _alone(rows: DataFrame) -> DataFrame:
    return _told(rows.withColumns({"n_links": F.lit(0), "component_id": F.col("vec_id")}))


def _linked(distinct: DataFrame, index: DataFrame, min_cosine: float) -> DataFrame:
    """uid, links, root from the blocks of all filters."""
    passed = index.withColumn("filter", F.explode("filters"))
    parts = saved(
        passed.groupBy("filter").agg(F.count("*").alias("n")).where(F.col("n") > 1)
        .select("filter", F.ceil(F.col("n") / PART).cast("int").alias("parts")),
        "filter-parts",
    )
    # A row goes to every pair of parts that its own part belongs to.
    mine = F.pmod(F.xxhash64("uid", "filter"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    dealt = (
        passed.join(parts, "filter").withColumn("part", mine).select("*", other)
        .select(
            "uid", "filter", "part", F.least("part", "other").alias("one"),
            F.greatest("part", "other").alias("two"),
        )
    )
    blocks = dealt.join(index, "uid").join(distinct.select("uid", "unit", "size"), "uid")
    return blocks.groupBy("filter", "one", "two").applyInArrow(
        _compare(min_cosine), "uid long, links long, root long"
    )
