"""What lies around positions against all pairs, on made-up rows."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from transit_engine.constants import POI_BOX_DEG
from transit_engine.operators import access, around

KINDS = [("cafe", "food"), ("school", "education"), ("hospital", "healthcare"), ("park", "park"),
         ("supermarket", "grocery"), (None, None), ("moon", "sky")]


def distance(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 12742000 * math.asin(math.sqrt(h))


def made_up(spark, n, lat, spread, seed):
    rng = random.Random(seed)

    def at():
        # Some positions on a coarse raster, so that places share them and lie on borders.
        y, x = (rng.gauss(0, spread) if rng.random() < 0.5 else rng.uniform(-spread, spread) for _ in "yx")
        return (round(lat + y, 3), round(-71 + x, 3)) if rng.random() < 0.2 else (lat + y, -71 + x)

    stops = [("b", str(i), f"s{i}", *at()) for i in range(n)]
    pois = [("b" if rng.random() < 0.9 else "c", i, *rng.choice(KINDS), *at()) for i in range(2 * n)]
    odd = [float("nan"), float("inf"), None]
    stops += [("b", f"odd{i}", "odd", v, -71.0) for i, v in enumerate(odd)] + [(None, "n", "n", lat, -71.0)]
    pois += [("b", -1, "cafe", "food", v, -71.0) for v in odd] + [(None, -2, "cafe", "food", lat, -71.0)]
    names = "city string, stop_id string, stop_name string, stop_lat double, stop_lon double"
    kinds = "city string, osm_id int, poi_category string, poi_group string, lat double, lon double"
    return stops, pois, spark.createDataFrame(stops, names), spark.createDataFrame(pois, kinds)


def brute(stops, pois, exact):
    for city, stop, _, a, b in stops:
        if city is None or a is None or not math.isfinite(a):
            continue
        near = [
            (distance(a, b, c, d), category, group) for other, _, category, group, c, d in pois
            if other == city and c is not None and math.isfinite(c) and distance(a, b, c, d) <= 400
            and (exact or (abs(a - c) < POI_BOX_DEG[0] and abs(b - d) < POI_BOX_DEG[1]))
        ]
        if not near:
            continue

        def nearest(which):
            return min((round(m, 2) for m, *kind in near if which(*kind)), default=None)

        yield (
            stop, len(near), sum(g == "food" for *_, g in near),
            sum(g in ("healthcare", "education", "grocery") for *_, g in near),
            sum(g == "park" for *_, g in near), nearest(lambda c, g: c == "school"),
            nearest(lambda c, g: c == "hospital"), nearest(lambda c, g: g == "grocery"),
            nearest(lambda c, g: g == "park"), ", ".join(sorted({c for _, c, _ in near} - {None, "moon"})),
        )


@pytest.mark.parametrize("lat, spread, exact, split_rows, seed", [
    (42.3, 0.003, False, 200_000, 1), (42.3, 0.02, False, 200_000, 2), (42.3, 0.004, False, 150, 3),
    (69.0, 0.01, True, 200_000, 4), (0.0, 0.006, False, 200_000, 5), (42.3, 0.0002, False, 200_000, 6),
])
def test_what_lies_around_equals_all_pairs(spark, lat, spread, exact, split_rows, seed):
    stops, pois, stop_rows, poi_rows = made_up(spark, 500, lat, spread, seed)
    found = access.stop_poi_access(stop_rows, poi_rows, exact, split_rows)
    near = [F.round(name, 2) for name in access.ACCESS_DISTANCES]
    expected = sorted(brute(stops, pois, exact), key=repr)
    assert len(expected) > 300
    assert rows(found, "stop_id", *access.ACCESS_COUNTS, *near, "poi_categories") == expected


def test_measured_pairs_grow_less_than_all_pairs(spark, monkeypatch):
    """Four times the places around as many stops: sixteen times the pairs, not so the measured ones."""
    import numpy as np

    measured = []
    reached = around._Block.reached

    def counted(self, position, place):
        measured[-1] += len(position)
        return reached(self, position, place)

    monkeypatch.setattr(around._Block, "reached", counted)
    rng = np.random.default_rng(1)
    for n in (4_000, 16_000):
        measured.append(0)
        points = [around._Points.__new__(around._Points) for _ in range(2)]
        for point, wide in zip(points, (1, 3), strict=True):
            point.lat = 42.3 + rng.random(n) * 0.004 * wide - 0.002 * wide
            point.lon = -71.0 + rng.random(n) * 0.005 * wide - 0.0025 * wide
            point.cos = np.cos(np.radians(point.lat))
        block = around._Block(*points, 400.0, POI_BOX_DEG)
        total, _ = around._totals(block, np.ones((n, 1), np.int64), np.ones(n, np.int64))
        nearest = around._nearest(block, np.arange(n))
        assert total.min() > n / 8 * 0.2 and np.isfinite(nearest).all()
    assert measured[1] < 10 * measured[0] and measured[1] < total.sum() / 3


def test_a_place_goes_to_few_blocks(spark):
    """It went to nine cells; now to the blocks within reach, fewer than two on average."""
    from transit_engine.operators.range_join import Reach

    n = 20_000
    many = spark.range(n).select(
        "id", (42.3 + F.rand(1) * 0.2).alias("lat"), (-71.0 + F.rand(2) * 0.2).alias("lon")
    )
    for exact in (False, True):
        near = around._blocks_near(many, ["lat", "lon"], Reach(400.0, POI_BOX_DEG, exact))
        copies = near.groupBy("id").count()
        assert copies.count() == n and copies.agg(F.max("count")).first()[0] == 4
        assert near.count() < 2.5 * n
        own = around._own_block(many, ["lat", "lon"], Reach(400.0, POI_BOX_DEG, exact))
        assert own.join(near, ["id", "_band", "_column"], "left_semi").count() == n


def test_lines_tell_most_pairs(spark, monkeypatch):
    """Distances of pairs well within or beyond reach are not worked out for the sums."""
    import numpy as np

    measured = []
    reached = around._Block.reached
    monkeypatch.setattr(
        around._Block, "reached", lambda self, a, b: measured.append(len(a)) or reached(self, a, b)
    )
    rng = np.random.default_rng(3)
    points = [around._Points.__new__(around._Points) for _ in range(2)]
    for point in points:
        point.lat, point.lon = 42.3 + rng.random(5_000) * 0.016, -71.0 + rng.random(5_000) * 0.02
        point.cos = np.cos(np.radians(point.lat))
    for box in (POI_BOX_DEG, None, (0.002, 0.003)):
        block = around._Block(*points, 400.0, box)
        total, _ = around._totals(block, np.ones((5_000, 1), np.int64), np.ones(5_000, np.int64))
        counted = sum(measured)
        pair = np.repeat(np.arange(5_000), 5_000), np.tile(np.arange(5_000), 5_000)
        near, _ = reached(block, *pair)
        assert total[:, 0].tolist() == near.reshape(5_000, 5_000).sum(axis=1).tolist()
        assert box == (0.002, 0.003) or counted < 100
        measured.clear()


@pytest.mark.parametrize("lat, spread, exact, split_rows, seed", [
    (42.3, 0.003, False, None, 1), (42.3, 0.02, False, None, 2), (42.3, 0.004, False, 150, 3),
    (69.0, 0.01, True, None, 4), (60.0, 0.006, False, None, 5), (0.0, 0.0002, False, None, 6),
])
def test_folded_pairs_equal_the_pairs(spark, lat, spread, exact, split_rows, seed):
    from transit_engine.constants import POI_RADIUS_M
    from transit_engine.functions.geo import finite
    from transit_engine.operators.range_join import Reach, near_pairs

    _, _, stops, pois = made_up(spark, 400, lat, spread, seed)
    # Copies of a row, ids that come at two places, and rows without an id.
    moved = stops.where("stop_id < '2'").withColumn("stop_lat", F.col("stop_lat") + 0.001)
    nameless = stops.where("stop_id > '35'").withColumn("stop_id", F.lit(None).cast("string"))
    stops = stops.unionByName(stops.where("stop_id < '15'")).unionByName(moved).unionByName(nameless)
    pois = pois.unionByName(pois.where("osm_id % 3 = 0"))
    stops, pois = stops.select("city", "stop_id", "stop_lat", "stop_lon"), pois.select("city", "osm_id", "lat", "lon")
    how = ["stop_lat", "stop_lon"], ["lat", "lon"], Reach(POI_RADIUS_M, POI_BOX_DEG, exact)
    known = stops.where(finite(F.col("stop_lat"))), pois.where(finite(F.col("lat")))
    expected = near_pairs(*known, *how).groupBy("city", "stop_id").agg(
        F.count(F.lit(1)).alias("pairs"), F.min("distance_m").alias("nearest_m"),
        F.max("distance_m").alias("farthest_m"), F.sum(F.floor("distance_m")).alias("whole_metres"),
    )
    names = ["city", "stop_id", "pairs", "whole_metres", F.round("nearest_m", 6), F.round("farthest_m", 6)]
    folded = near_pairs(stops, pois, *how, split_rows=split_rows, per=["stop_id"])
    assert folded.columns == expected.columns and folded.dtypes == expected.dtypes
    assert len(rows(expected, *names)) > 300 and rows(folded, *names) == rows(expected, *names)


def test_distances_next_to_a_whole_metre_and_the_edge(spark):
    """Lines don't tell them from rounding; places are put there on purpose."""
    import numpy as np

    rng = np.random.default_rng(7)
    points = [around._Points.__new__(around._Points) for _ in range(2)]
    points[0].lat, points[0].lon = np.full(5, 42.3), np.full(5, -71.0)
    metres = np.concatenate([
        np.arange(0, 402) + step for step in (0.0, 1e-9, -1e-9, 1e-8, -1e-8, 3e-7, -3e-7)
    ])
    points[1].lat = 42.3 + metres / (math.pi * around.EARTH_RADIUS_M / 180)
    points[1].lon = np.full(len(metres), -71.0)
    for point in points:
        point.cos = np.cos(np.radians(point.lat))
    number = rng.integers(1, 4, len(metres))
    block = around._Block(*points, 400.0, POI_BOX_DEG)
    pairs, nearest, farthest, whole = around._measured(block, number)
    near, distance = block.reached(np.zeros(len(metres), np.int64), np.arange(len(metres)))
    assert (pairs == number[near].sum()).all()
    assert (whole == (np.floor(distance) * number)[near].sum()).all()
    assert (nearest == distance.min()).all() and (farthest == distance[near].max()).all()


def test_pairs_of_a_dense_region_are_folded_as_matrices(spark):
    """100 million pairs: as rows of a join they took minutes here."""
    import time

    from transit_engine.constants import POI_RADIUS_M
    from transit_engine.operators.range_join import Reach, near_pairs

    def scattered(n, id_, lat, lon):
        return spark.range(n).select(
            F.lit("b").alias("city"), F.col("id").alias(id_), (42.3 + F.rand(1) * 0.002).alias(lat),
            (-71.0 + F.rand(2) * 0.002).alias(lon),
        )

    started = time.monotonic()
    folded = near_pairs(
        scattered(10_000, "stop_id", "stop_lat", "stop_lon"), scattered(10_000, "osm_id", "lat", "lon"),
        ["stop_lat", "stop_lon"], ["lat", "lon"], Reach(POI_RADIUS_M, POI_BOX_DEG), per=["stop_id"],
    )
    assert folded.agg(F.sum("pairs")).first()[0] == 10_000 * 10_000
    assert time.monotonic() - started < 60
