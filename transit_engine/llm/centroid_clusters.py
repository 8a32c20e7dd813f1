"""Centroid clustering on bit planes.

A vector of 64 components becomes 64 integers, and the integers become bit planes in two's
complement: plane ``p`` holds bit ``p`` of all components in one unsigned 64-bit word. With the
weights of the planes, a dot product is a weighted sum of popcounts,

    x . c = sum over p, q of  w[p] * w[q] * popcount(x[p] & c[q])

which is exact, as are the squared distances made of it. Vectors are packed once and written below
the shared folder; every round reads the packed planes only. A task folds its vectors to one row
of sums per centroid, so that a round sends (tasks x centroids) rows, and the driver gets one row
per centroid, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.llm.common import saved

DIMENSION = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
# Larger integers have squared distances beyond 64 bits.
MAX_COMPONENT = 2**27
_BITS = np.arange(DIMENSION, dtype=np.uint64)


def weights(n_planes: int) -> np.ndarray:
    """What a bit of each plane counts for; the last plane is the sign."""
    values = np.left_shift(np.int64(1), np.arange(n_planes, dtype=np.int64))
    values[-1] = -values[-1]
    return values


def packed(values: np.ndarray, n_planes: int) -> np.ndarray:
    """(n, 64) integers -> (n, planes) words."""
    planes = np.empty((len(values), n_planes), np.uint64)
    for p in range(n_planes):
        planes[:, p] = (((values >> p) & 1).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)
    return planes


def unpacked(planes: np.ndarray) -> np.ndarray:
    """(n, planes) words -> (n, 64) integers."""
    values = np.zeros((len(planes), DIMENSION), np.int64)
    for p, weight in enumerate(weights(planes.shape[1])):
        values += weight * ((planes[:, p, None] >> _BITS) & np.uint64(1)).astype(np.int64)
    return values


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Dot products of (n, planes) with (k, planes) by AND and popcount."""
    weight, result = weights(x.shape[1]), np.zeros((len(x), len(c)), np.int64)
    for p in range(x.shape[1]):
        for q in range(x.shape[1]):
            both = np.bitwise_count(x[:, p, None] & c[None, :, q])
            result += (weight[p] * weight[q]) * both.astype(np.int64)
    return result


def squares(x: np.ndarray) -> np.ndarray:
    """Squared lengths, from the planes of one vector at a time."""
    weight, result = weights(x.shape[1]), np.zeros(len(x), np.int64)
    for p in range(x.shape[1]):
        for q in range(p, x.shape[1]):
            both = np.bitwise_count(x[:, p] & x[:, q]).astype(np.int64)
            result += (weight[p] * weight[q] * (1 if p == q else 2)) * both
    return result


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (of a tie the smaller) and squared distance to it."""
    distances = squares(x)[:, None] - 2 * dots(x, c) + squares(c)[None, :]
    number = distances.argmin(axis=1)
    return number, distances[np.arange(len(x)), number]


@dataclass
class Clustering:
    """One row per kept vector, and the final centroids (k, 64), at most ``CLUSTERS`` of them."""

    rows: DataFrame
    centroids: np.ndarray


def _integers(vectors: DataFrame, column: str, scale: int) -> DataFrame:
    """vec_id and the integers of the kept vectors."""
    whole = F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    usable = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = F.when((F.size(column) == DIMENSION) & usable, F.col(column)).alias(column)
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), kept)
        .where(F.col(column).isNotNull())
        .select("vec_id", whole.alias("x"))
    )


def _words(array: pa.Array, n_planes: int) -> np.ndarray:
    """A column of packed planes as words."""
    return np.frombuffer(b"".join(array.to_pylist()), "<u8").reshape(-1, n_planes)


def _packed(integers: DataFrame, n_planes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSION)
            words = packed(values, n_planes).astype("<u8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([row.tobytes() for row in words], pa.binary())],
                names=["vec_id", "planes"],
            )

    return integers.mapInArrow(run, "vec_id long, planes binary")


def _sums(vectors: DataFrame, centroids: np.ndarray, n_planes: int) -> np.ndarray:
    """Per centroid the sums of its vectors' components, and their number at the end."""
    c = packed(centroids, n_planes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(c), DIMENSION + 1), np.int64)
        for batch in batches:
            x = _words(batch.column(0), n_planes)
            number, _ = nearest(x, c)
            values = unpacked(x)
            for k in np.unique(number):
                sums[k, :-1] += values[number == k].sum(axis=0)
            sums[:, -1] += np.bincount(number, minlength=len(c))
        cluster, place = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(sums[cluster, place])],
            names=["cluster", "place", "total"],
        )

    told = vectors.select("planes").mapInArrow(run, "cluster int, place int, total long")
    # Decimals, as the sums of very many vectors need not fit in 64 bits.
    total = told.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = np.zeros((len(c), DIMENSION + 1), object)
    for row in total.collect():
        sums[row["cluster"], row["place"]] = int(row["total"])
    return sums


def _assigned(vectors: DataFrame, centroids: np.ndarray, n_planes: int) -> DataFrame:
    c = packed(centroids, n_planes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = nearest(_words(batch.column(1), n_planes), c)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number, pa.int32()), pa.array(distance)],
                names=["vec_id", "cluster", "distance"],
            )

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def _drawn(seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)


def clustered(
    vectors: DataFrame,
    column: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
) -> Clustering:
    """Lloyd rounds from ``k`` vectors drawn by hash: vec_id, cluster and squared distance.

    Vectors that are null, have another number of components or hold one that is null or not
    finite are left out. Repeated rows count as often as they are there; of rows with one vec_id
    the smaller vector comes first in the draw, and a null vec_id comes last. Fewer vectors than
    ``k`` give as many centroids; an empty table gives no rows. Other columns are not looked at.
    Integers of ``MAX_COMPONENT`` and more raise an error, as their distances are no longs.
    """
    integers = _integers(vectors, column, scale)
    largest = integers.select(F.max(F.array_max(F.transform("x", lambda v: F.abs(v.cast("double")) + 1)))).first()[0]
    if largest is not None and largest > MAX_COMPONENT:
        raise ValueError(f"components of {largest / scale:.3g} are too large at scale {scale}")
    n_planes = int(largest or 1).bit_length() + 1
    order = [_drawn(seed).asc_nulls_last(), F.col("x")]
    first = integers.orderBy(*order).limit(k).collect()
    centroids = np.array([row["x"] for row in first], np.int64).reshape(-1, DIMENSION)
    rows = saved(_packed(integers, n_planes), "cluster-planes")
    for _ in range(rounds if len(centroids) else 0):
        following = centroids.copy()
        for number, (*sums, n) in enumerate(_sums(rows, centroids, n_planes)):
            if n:
                following[number] = [total // n for total in sums]
        if (following == centroids).all():
            break  # no later round changes anything
        centroids = following
    return Clustering(_assigned(rows, centroids, n_planes), centroids)


def described(clustering: Clustering) -> DataFrame:
    """The rows with the inertia of their cluster and of all, and the hash of their centroid.

    The written assignment is summed per cluster; one row per centroid is sent back to the rows.
    """
    rows = saved(clustering.rows, "cluster-rows")
    spark, sums = rows.sparkSession, rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    total = sum(row["d"] for row in sums)
    told = [
        (
            row["cluster"], row["d"], total,
            hashlib.sha256(",".join(map(str, clustering.centroids[row["cluster"]])).encode()).hexdigest(),
        )
        for row in sums
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # At most as many rows as there are centroids.
    return rows.join(F.broadcast(spark.createDataFrame(told, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
