from conftest import rows
from pyspark.sql import functions as F

from transit_engine.operators import presentation, serving
from transit_engine.sinks import datasets
from transit_engine.sources.files import read_dataset

STOPS = (
    "city string, route_id string, stop_id string, stop_name string, trip_count long, "
    "avg_daily_stop_events double, poi_count_within_400m long, "
    "food_poi_count_within_400m long, critical_service_poi_count_within_400m long, "
    "park_poi_count_within_400m long, poi_categories string, stop_lat double, stop_lon double"
)


def route_stops(spark, *lines):
    return spark.createDataFrame(
        [("b", route, stop, name, trips, 1.0, places, 0, 0, 0, text, 42.0, -71.0)
         for route, stop, name, trips, places, text in lines], STOPS
    )


def summaries(spark):
    return spark.createDataFrame(
        [("b", "1", "1", 100), ("b", "2", "2", 50), ("b", "3", "3", 0)],
        "city string, route_id string, route_short_name string, stop_event_count long",
    )


def test_previews_hold_the_first_stops_per_route(spark):
    context = route_stops(
        spark, ("1", "a", "Alpha", 30, 1, ""), ("1", "b", "Bravo", 20, 1, ""),
        ("1", "c", "Charlie", 10, 1, ""), ("2", "d", "Delta", 25, None, None),
    )
    previews = {r["route_id"]: r for r in serving.route_preview(summaries(spark), context, 2).collect()}
    names = {k: [s["stop_name"] for s in r["stops"]] for k, r in previews.items()}
    assert names == {"1": ["Alpha", "Bravo"], "2": ["Delta"], "3": []}
    assert previews["1"]["summary"]["stop_event_count"] == 100


def test_paths_are_lon_lat_in_order_with_two_points_at_least(spark):
    shapes = spark.createDataFrame(
        [("b", "1", "a", 2, 42.4, -71.2), ("b", "1", "a", 1, 42.3, -71.1),
         ("b", "1", "single", 1, 42.0, -71.0)],
        "city string, route_id string, shape_id string, shape_pt_sequence int, "
        "shape_pt_lat double, shape_pt_lon double",
    )
    paths = serving.route_paths(shapes).collect()
    assert [(p["shape_id"], p["path"]) for p in paths] == [("a", [[-71.1, 42.3], [-71.2, 42.4]])]
    assert rows(serving.route_path_points(shapes), "shape_id", "shape_pt_sequence") == [
        ("a", 1), ("a", 2),
    ]
    chosen = spark.createDataFrame([("b", "1"), ("b", "none")], "city string, route_id string")
    assert serving.route_shape_points(shapes, chosen).first()["shape_id"] == "a"
    detail = serving.route_detail(
        summaries(spark), route_stops(spark, ("1", "a", "Alpha", 3, 1, "")), shapes,
        spark.createDataFrame([("b", "1"), ("b", "nope")], "city string, route_id string"),
    ).collect()
    assert len(detail) == 1
    assert len(detail[0]["stops"]) == 1 and len(detail[0]["paths"]) == 1


def test_records_are_lower_case_without_nan(spark):
    frame = spark.createDataFrame(
        [("Nubian", 10414, float("nan")), ("Ashmont", 7570, 100.5)],
        "STOP_NAME string, TRIP_COUNT long, NEAREST_HOSPITAL_M double",
    )
    records = serving.records_normalise(frame)
    assert records.columns == ["stop_name", "trip_count", "nearest_hospital_m"]
    assert rows(records) == [("Ashmont", 7570, 100.5), ("Nubian", 10414, None)]


def test_reports_of_one_city_and_of_all(spark):
    coverage = spark.createDataFrame(
        [("b", "primary", 50.0, 1.0), ("b", "service", None, 9.0), ("c", "trunk", 1.0, 1.0)],
        "city string, highway string, coverage_pct double, total_length_km double",
    )
    report = serving.road_coverage_report(coverage, "b").collect()
    assert [r["highway"] for r in report] == ["primary", "service"]
    assert serving.road_coverage_report(coverage).count() == 3
    assert serving.road_coverage_report(coverage, "atlantis").count() == 0


def test_cities_without_data_compare_as_zero(spark):
    from transit_engine.constants import CITIES

    empty = spark.createDataFrame([], "city string, total_stops long")
    leader = spark.createDataFrame([], "city string, stop_name string")
    compared = serving.city_comparison(empty, leader, leader, leader)
    assert rows(compared, "city", "total_stops") == sorted((c[0], 0) for c in CITIES)


def test_rollup_merges_platforms(spark):
    context = route_stops(
        spark, ("1", "a", "Hub", 10, 3, "cafe, park"), ("1", "b", "Hub", 30, 1, "park, bank"),
        ("1", "c", "", 50, None, None),
    )
    merged = presentation.stop_display_labels(presentation.route_stop_rollup(context))
    assert rows(merged, "stop_key", "stop_id", "stop_instances", "trip_count",
                "poi_count_within_400m", "poi_categories", "display_label") == [
        ("Hub", "b", 2, 40, 3, "bank, cafe, park", "Hub (2 platforms)"),
        ("c", "c", 1, 50, 0, "", "c"),
    ]


def test_shares_and_ratios(spark):
    mix = spark.createDataFrame(
        [("b", "x", 3), ("b", "y", 1), ("c", "z", 0)], "city string, name string, n long"
    )
    shares = presentation.share_of_total(mix, "n", ["-n", "name"])
    assert rows(shares, "name", "share", "share_start", "share_end") == [
        ("x", 0.75, 0.0, 0.75), ("y", 0.25, 0.75, 1.0), ("z", 0.0, 0.0, 0.0),
    ]
    ratios = presentation.ratio_to_max(mix, F.col("n"))
    assert rows(ratios, "name", "ratio") == [("x", 1.0), ("y", 1 / 3), ("z", 0.0)]


def test_only_finite_coordinates_stay(spark):
    places = spark.createDataFrame(
        [(1, 1.0, 2.0), (2, None, 2.0), (3, float("nan"), 2.0), (4, 1.0, float("inf"))],
        "id int, lon double, lat double",
    )
    assert rows(presentation.finite_coordinates(places, "lon", "lat"), "id") == [(1,)]


def test_rewriting_one_city_leaves_the_others(spark, tmp_path):
    both = spark.createDataFrame([("b", 1), ("b", 2), ("c", 3)], "city string, n int")
    assert datasets.write_dataset(both, str(tmp_path), "d") == {"d": 3}
    again = spark.createDataFrame([("b", 9)], "city string, n int")
    assert datasets.write_dataset(again, str(tmp_path), "d") == {"d": 1}
    assert rows(read_dataset(spark, str(tmp_path), "d", "city string, n int")) == [
        ("b", 9), ("c", 3),
    ]


def test_warehouse_skips_missing_cities(spark, tmp_path):
    spark.createDataFrame([(1,)], "n int").write.parquet(str(tmp_path / "b" / "d"))
    parts = datasets.city_folders(spark, {c: str(tmp_path / c) for c in ("b", "c")}, "d")
    assert datasets.warehouse_union(parts).columns == ["N"] and len(parts) == 1


def test_parts_of_a_route_without_summary_are_left_out_before_they_are_made(spark):
    """Heads were worked out a second time to tell; now the summary tells."""
    shapes = spark.createDataFrame(
        [("b", route, "a", i, 42.0 + i, -71.0) for route in ("1", "9") for i in range(4)],
        "city string, route_id string, shape_id string, shape_pt_sequence int, "
        "shape_pt_lat double, shape_pt_lon double",
    )
    wanted = spark.createDataFrame([("b", "1"), ("b", "9")], "city string, route_id string")
    context = route_stops(spark, ("1", "a", "Alpha", 3, 1, ""), ("9", "b", "Bravo", 3, 1, ""))
    parts = serving.route_detail_parts(summaries(spark), context, shapes, wanted, piece_points=2)
    found = rows(parts, "route_id", "part", "shape_id", "piece", F.size("stops"), F.size("path"))
    assert found == [("1", 0, None, None, 1, None), *[("1", i + 1, "a", i, None, 2) for i in range(3)]]
    text = parts._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("collect_list") == 1  # the stops of heads, once; pieces are written
