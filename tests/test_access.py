import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from transit_engine.operators import access
from transit_engine.operators.range_join import Reach, near_any, near_pairs

BOX, RADIUS = (0.004, 0.005), 400


def distance(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 12742000 * math.asin(math.sqrt(h))


def brute(left, right, boxed=True):
    return sorted(
        (i, j) for i, (city, a, b) in enumerate(left) for j, (other, c, d) in enumerate(right)
        if city == other and distance(a, b, c, d) <= RADIUS
        and (not boxed or (abs(a - c) < BOX[0] and abs(b - d) < BOX[1]))
    )


def frames(spark, left, right):
    return (
        spark.createDataFrame([(c, i, a, b) for i, (c, a, b) in enumerate(left)],
                              "city string, l int, stop_lat double, stop_lon double"),
        spark.createDataFrame([(c, i, a, b) for i, (c, a, b) in enumerate(right)],
                              "city string, r int, lat double, lon double"),
    )


def points(count, seed, lat=42.3, lon=-71.1, spread=0.02):
    rng = random.Random(seed)
    return [
        (rng.choice(["boston", "chicago"]), lat + rng.uniform(0, spread), lon + rng.uniform(0, spread))
        for _ in range(count)
    ]


def corners():
    """Positions on cell borders, either side of zero."""
    return [("boston", i * 0.004, j * 0.005) for i in range(-2, 3) for j in range(-2, 3)]


@pytest.mark.parametrize("split_rows", [20_000, 5])
@pytest.mark.parametrize("place", ["random", "crowded", "corners"])
def test_grid_equals_all_pairs(spark, place, split_rows):
    left, right = {
        "random": (points(80, 1), points(150, 2)),
        "crowded": (points(40, 3, spread=0.003), points(120, 4, spread=0.003)),
        "corners": (corners(), [(c, a + 0.0005, b - 0.0005) for c, a, b in corners()]),
    }[place]
    spread, fixed = frames(spark, left, right)
    reach = Reach(RADIUS, BOX)
    at = (["stop_lat", "stop_lon"], ["lat", "lon"])
    expected = brute(left, right)
    assert expected
    pairs = near_pairs(spread, fixed, *at, reach, split_rows=split_rows)
    assert rows(pairs, "l", "r") == sorted(expected, key=repr)
    any_near = near_any(fixed, spread, at[1], at[0], reach, split_rows=split_rows)
    assert rows(any_near, "r") == sorted({(j,) for _, j in expected}, key=repr)


def test_exact_reach_finds_what_the_box_misses_far_north(spark):
    left, right = points(60, 5, lat=69.0, spread=0.05), points(100, 6, lat=69.0, spread=0.05)
    spread, fixed = frames(spark, left, right)
    pairs = near_pairs(
        spread, fixed, ["stop_lat", "stop_lon"], ["lat", "lon"], Reach(RADIUS, BOX, exact=True)
    )
    assert rows(pairs, "l", "r") == sorted(brute(left, right, boxed=False), key=repr)
    assert len(brute(left, right, boxed=False)) > len(brute(left, right))


def test_plan_is_an_equi_join(spark):
    spread, fixed = frames(spark, points(5, 1), points(5, 2))
    pairs = near_pairs(spread, fixed, ["stop_lat", "stop_lon"], ["lat", "lon"], Reach(RADIUS, BOX))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def stops_and_pois(spark):
    stops = spark.createDataFrame(
        [("b", "1", "One", 42.0, -71.0), ("b", "2", "Same place", 42.0, -71.0),
         ("b", "3", "Far", 43.0, -71.0), ("c", "1", "Other city", 42.0, -71.0)],
        "city string, stop_id string, stop_name string, stop_lat double, stop_lon double",
    )
    pois = spark.createDataFrame(
        [("b", 1, "cafe", "food", 42.0, -71.0), ("b", 2, "cafe", "food", 42.0, -71.0),
         ("b", 3, "school", "education", 42.001, -71.0), ("b", 4, "park", "park", 42.002, -71.0),
         ("b", 5, "clinic", "healthcare", 42.0039, -71.0)],
        "city string, osm_id int, poi_category string, poi_group string, lat double, lon double",
    )
    return stops, pois


def test_access_counts_copies_and_leaves_out_stops_without_places(spark):
    found = access.stop_poi_access(*stops_and_pois(spark))
    result = rows(
        found, "city", "stop_id", *access.ACCESS_COUNTS, F.round("nearest_school_m", 1),
        "nearest_hospital_m", "poi_categories",
    )
    assert result == [
        ("b", "1", 4, 2, 1, 1, 111.2, None, "cafe, park, school"),
        ("b", "2", 4, 2, 1, 1, 111.2, None, "cafe, park, school"),
    ]


def test_route_access_mixes_zero_and_missing(spark):
    stops, pois = stops_and_pois(spark)
    by_route = stops.where("city = 'b' and stop_id <> '2'").select(
        "city", F.lit("r").alias("route_id"), F.lit("R").alias("route_short_name"),
        F.lit("Long").alias("route_long_name"), F.lit(3).alias("route_type"), "stop_id",
    )
    found = access.route_poi_access(by_route, access.stop_poi_access(stops, pois))
    assert rows(found, "stop_count", "total_poi_access", "avg_poi_access_per_stop",
                "stops_near_park") == [(2, 4, 4.0, 1)]


def test_uncovered_class_keeps_nulls(spark):
    stops, _ = stops_and_pois(spark)
    roads = spark.createDataFrame(
        [("b", "1", "primary", 42.0, -71.0, 1500.0), ("b", "2", "primary", 42.5, -71.0, None),
         ("b", "3", "service", 42.5, -71.0, 100.0)],
        "city string, osm_id string, highway string, mid_lat double, mid_lon double, length_m double",
    )
    assert rows(access.transit_road_coverage(roads, stops)) == [
        ("b", "primary", 2, 1, 50.0, 1.5, 1.5), ("b", "service", 1, None, None, 0.1, None),
    ]
