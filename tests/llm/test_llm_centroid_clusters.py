"""Bit-plane distances against plain integers, rounds against a slow version, and edges."""

import hashlib
import math

import numpy as np
import pytest
from check import compare, database
from pyspark.sql import functions as F

from transit_engine.llm import centroid_clusters as cc


@pytest.mark.parametrize("largest", [1, 7, 1024, 2**27 - 1])
def test_popcounts_give_exact_dot_products(largest):
    rng = np.random.default_rng(largest)
    values = rng.integers(-largest, largest, (50, 64))
    values[0], values[1], values[2] = largest - 1, -largest, 0
    n_planes = largest.bit_length() + 1
    planes = cc.packed(values, n_planes)
    assert (cc.unpacked(planes) == values).all()
    exact = values.astype(object) @ values[:9].astype(object).T
    assert (cc.dots(planes, planes[:9]) == exact).all()
    number, distance = cc.nearest(planes, planes[:9])
    for row, k, d in zip(values.astype(object), number, distance):
        all_of = [int(((row - c) ** 2).sum()) for c in values[:9].astype(object)]
        assert (min(all_of), all_of.index(min(all_of))) == (d, k)


def slow(rows, k=8, rounds=10):
    """(vec_id, cluster, distance, centroid hash) by plain Python."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    drawn = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in drawn[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        held = [[] for _ in centroids]
        for _, v in kept:
            held[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(held, centroids)]
    return sorted(
        ((i, *nearest(v)[::-1], hashlib.sha256(",".join(map(str, centroids[nearest(v)[1]])).encode()).hexdigest())
         for i, v in kept), key=repr)


def table_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {name: F.lit("x") for name in ("x", "planes", "cluster", "distance", "inertia", "label")}
    )


def test_edges(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(x) for x in rng.normal(size=64)] for _ in range(40)]
    nan, inf = float("nan"), float("inf")
    rows = [(i, v) for i, v in enumerate(vectors)] + [
        (0, vectors[0]), (0, vectors[0]), (3, vectors[4]), (None, vectors[5]), (None, None), (50, None),
        (51, []), (52, vectors[0][:63]), (53, vectors[0] + [0.0]), (54, [nan] * 64), (55, [inf] + [0.0] * 63),
        (56, [None] + [0.0] * 63), (57, [0.0] * 64), (58, [-0.0] * 64),
    ]
    found = cc.described(cc.clustered(table_of(spark, rows)))
    expected = slow(rows)
    got = [(r["vec_id"], r["cluster"], r["distance"], r["centroid_sha256"]) for r in found.collect()]
    assert sorted(got, key=repr) == expected
    told = found.select("cluster", "cluster_inertia", "inertia").distinct().collect()
    assert all(r["inertia"] == sum(e[2] for e in expected) for r in told)
    assert all(r["cluster_inertia"] == sum(e[2] for e in expected if e[1] == r["cluster"]) for r in told)


def test_few_and_no_vectors(spark):
    rows = [(1, [0.5] * 64), (1, [0.5] * 64), (2, [-0.25] * 64)]
    got = [(r["vec_id"], r["distance"]) for r in cc.described(cc.clustered(table_of(spark, rows))).collect()]
    assert sorted(got) == [(1, 0), (1, 0), (2, 0)]
    none = cc.described(cc.clustered(table_of(spark, rows).where("false")))
    assert none.count() == 0 and none.columns[0] == "vec_id"


def test_too_large_components_are_refused(spark):
    with pytest.raises(ValueError, match="too large"):
        cc.clustered(table_of(spark, [(1, [1e30] * 64)]))


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_query_equals_sql(spark, scale):
    sf_dir = f"/root/testdata/sf{scale}"
    equal, message = compare(spark, database(sf_dir), "op11_centroid_clusters", sf_dir)
    assert equal, message
