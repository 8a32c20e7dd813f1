"""Nothing is dropped without a word: limits, categories, headers, empty cities, scratch folders."""

import shutil

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from transit_engine import session
from transit_engine.catalog import surrogate
from transit_engine.functions.times import parse_iso_timestamp
from transit_engine.operators import activity, presentation, serving
from transit_engine.operators.keyed import best_per_key
from transit_engine.sinks import datasets
from transit_engine.sources.files import read_dataset, scan_osm


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_a_section_holds_all_rows_of_its_report(spark):
    report = spark.range(1500).select(
        F.lit("b").alias("city"), F.col("id").cast("string").alias("highway"),
        F.col("id").cast("double").alias("coverage_pct"), F.lit(1.0).alias("total_length_km"),
    )
    section = serving.section_list(report, serving.ORDER["road_coverage_report"], "roads")
    assert section.select(F.size("roads")).first()[0] == 1500


def test_unknown_categories_stay_in_the_rollup(spark):
    base = spark.createDataFrame(
        [("b", "1", "s1", "Hub", 1.0, 1.0, 1, 1.0), ("b", "1", "s2", "Hub", 1.0, 1.0, 1, 1.0)],
        "city string, route_id string, stop_id string, stop_name string, stop_lat double, "
        "stop_lon double, trip_count long, avg_daily_stop_events double",
    )
    context = base.withColumns(
        {name: F.lit(0).cast("long") for name in presentation.ACCESS_COUNTS}
    ).withColumn(
        "poi_categories", F.when(F.col("stop_id") == "s1", "cafe, moon base").otherwise("zoo,cafe")
    )
    merged = presentation.route_stop_rollup(context)
    assert rows(merged, "stop_instances", "poi_categories") == [(2, "cafe, moon base, zoo")]


def test_an_extract_with_another_header_is_an_error(spark, tmp_path):
    for city, text in (("good", "osm_id,name\n1,a\n"), ("empty", "\n"), ("wrong", "id,name\n1,a\n")):
        (tmp_path / city).mkdir()
        (tmp_path / city / "pois.csv").write_text(text)
    folders = {city: str(tmp_path / city) for city in ("good", "empty")}
    assert rows(scan_osm(spark, folders, "pois"), "city", "osm_id") == [("good", "1")]
    with pytest.raises(ValueError, match="wrong/pois.csv"):
        scan_osm(spark, folders | {"wrong": str(tmp_path / "wrong")}, "pois")


def test_a_city_that_becomes_empty_is_cleared(spark, tmp_path):
    both = spark.createDataFrame([("b", 1), ("c", 3), ("d", 4)], "city string, n int")
    datasets.write_dataset(both, str(tmp_path), "x")
    only = spark.createDataFrame([("b", 9)], "city string, n int")
    assert datasets.write_dataset(only, str(tmp_path), "x", ["b", "c"]) == {"x": 1}
    left = read_dataset(spark, str(tmp_path), "x", "city string, n int")
    assert rows(left) == [("b", 9), ("d", 4)]


def test_a_large_limit_is_ranked_in_parts(spark):
    city = F.when(F.col("id") < 20_000, "b").alias("city")
    many = spark.range(20_000).select(city, "id", (F.col("id") % 97).alias("v"))
    best = best_per_key(many, ["city"], ["-v", "id"], 2000)
    expected = sorted(((i % 97, i) for i in range(20_000)), key=lambda x: (-x[0], x[1]))[:2000]
    assert sorted(r["id"] for r in best.collect()) == sorted(i for _, i in expected)
    windows = [line for line in plan(best).splitlines() if "_part" in line and "hashpartitioning" in line]
    assert windows and "city" in windows[0]
    assert "WindowGroupLimit" in plan(best_per_key(many, ["city"], ["-v", "id"], 200))


def test_only_date_and_time_are_feed_times(spark):
    texts = ["10:20", "2024", "2024-05-01", "2024-05-01T10:20:30Z", "2024-05-01T10:20:30-04:00",
             "2024-05-01 10:20:30.5+00:00", "today", "", None]
    parsed = spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.unix_seconds(parse_iso_timestamp(F.col("t"))).alias("s")
    )
    assert [r["s"] for r in parsed.collect()] == [
        None, None, None, 1714558830, 1714573230, 1714558830, None, None, None,
    ]


class Elsewhere:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Elsewhere)


def test_route_activity_joins_stop_times_once_and_expands_nothing(spark):
    events = spark.createDataFrame(
        [("b", "t", "s", "r", 1)],
        "city string, trip_id string, stop_id string, route_id string, active_service_days long",
    )
    routes = spark.createDataFrame(
        [("b", "r", "1", "One", 3)],
        "city string, route_id string, route_short_name string, route_long_name string, route_type int",
    )
    feed = spark.createDataFrame([("b", 1)], "city string, feed_days long")
    trips = activity.running_trips(events, events)
    table = activity.route_activity(activity.route_stop_counts(events), trips, routes, feed)
    assert "Expand" not in plan(table)


def test_maxima_by_city_leave_the_rows_where_they_are(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        city = F.when(F.col("id") < 10, "b").alias("city")
        table = spark.range(10).select(city, F.col("id").cast("double").alias("n"))
        text = plan(presentation.ratio_to_max(table, F.col("n")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_one_city_reads_only_its_folders(spark, tmp_path):
    table = spark.createDataFrame([("b", 1), ("c", 2)], "city string, n int")
    datasets.write_dataset(table, str(tmp_path), "d")
    read = read_dataset(spark, str(tmp_path), "d", "city string, n int").where(F.col("city") == "b")
    assert "PartitionFilters: [isnotnull(city" in plan(read)
    assert rows(read, "city", "n") == [("b", 1)]


def test_written_tables_follow_tables_replaced_in_a_session(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for table in surrogate._SCHEMAS:
        shutil.copyfile(f"{source}/{table}.parquet", tmp_path / f"{table}.parquet")

    def told():
        tables = surrogate.Surrogate(spark, str(tmp_path))
        return rows(tables.written.stop_activity), rows(tables.stop_activity), len(surrogate._BUILT)

    first = told()
    assert first[0] == first[1] and told() == first
    half = pq.read_table(f"{source}/lineitem.parquet")
    pq.write_table(half.slice(0, half.num_rows // 2), tmp_path / "lineitem.parquet")
    again = told()
    assert again[0] == again[1] != first[1]
