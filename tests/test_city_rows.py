"""The work of a few cities and of small files is spread over tasks."""

from conftest import rows

from transit_engine.catalog.surrogate import Surrogate
from transit_engine.operators import access, activity, service_calendar


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_averages_leave_the_rows_where_they_are(spark):
    """A join by city would put all rows of a city into one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = spark.createDataFrame(
            [("b", "r", "s", 3, 10), ("c", "r", "s", 1, 4), (None, "r", "s", 2, 5)],
            "city string, route_id string, stop_id string, trip_count long, service_days long",
        )
        feed = spark.createDataFrame([("b", 4)], "city string, feed_days long")
        table = activity.stop_activity(counts, feed)
        text = plan(table)
        assert rows(table, "city", "avg_daily_stop_events") == sorted(
            [("b", 2.5), ("c", 4.0), (None, 5.0)], key=repr
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(city#" in text and "SortMergeJoin" not in text


def test_a_calendar_is_dealt_to_tasks_before_it_becomes_dates(spark):
    calendar = spark.createDataFrame(
        [("b", str(i), *"1111111", "20240101", "20240107") for i in range(40)],
        "city string, service_id string, monday string, tuesday string, wednesday string, thursday string, "
        "friday string, saturday string, sunday string, start_date string, end_date string",
    ).coalesce(1)
    dates = service_calendar.active_service_dates(calendar, None)
    text = plan(dates)
    assert "REPARTITION_BY_NUM" in text[text.index("Generate"):], text
    assert dates.count() == 280


def test_access_is_worked_out_once_for_all_tables_built_on_it(spark):
    s = Surrogate(spark, "no folder")
    s.__dict__["stops"] = spark.createDataFrame(
        [("b", "1", "One", 42.0, -71.0), ("b", "2", "Far", 43.0, -71.0)],
        "city string, stop_id string, stop_name string, stop_lat double, stop_lon double",
    )
    s.__dict__["pois"] = spark.createDataFrame(
        [("b", 1, "cafe", "food", 42.0, -71.0)],
        "city string, osm_id int, poi_category string, poi_group string, lat double, lon double",
    )
    told = access.stop_poi_access(s.stops, s.pois)
    assert s.stop_poi_access.dtypes == told.dtypes and rows(s.stop_poi_access) == rows(told)
    assert "FlatMapCoGroups" in plan(told) and "FlatMapCoGroups" not in plan(s.stop_poi_access)


def test_running_dates_are_worked_out_once(spark, tmp_path):
    """Days per service and days per feed each worked them out anew."""
    spark.createDataFrame(
        [(10, "Ten", 1, "BUILDING"), (23, "More", 1, "BUILDING")],
        "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    ).write.parquet(str(tmp_path / "customer.parquet"))
    s = Surrogate(spark, str(tmp_path))
    dates = s.known_dates
    assert not any("customer.parquet" in file for file in dates.inputFiles())
    assert rows(dates) == rows(s.active_dates) and dates.count() > 2
    assert rows(s.known_feed_days) == rows(s.feed_days)


def small_transit(spark, folder):
    """Three orders with the rows of their schedule, and what they refer to."""
    tables = {
        "part": ([(i, f"P{i}", i) for i in (1, 2, 3)], "p_partkey long, p_name string, p_size int"),
        "customer": (
            [(10, "Ten", 1, "BUILDING"), (23, "More", 1, "BUILDING")],
            "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
        ),
        "orders": (
            [(4, 10, "O", 1.0), (6, 10, "O", 2.0), (8, 23, "O", 3.0)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double",
        ),
        "lineitem": (
            [(4, 1, 1, 1, 1.0, "A", "F"), (4, 2, 1, 2, 1.0, "A", "F"), (6, 2, 1, 1, 1.0, "A", "F"),
             (8, 3, 1, 1, 1.0, "A", "F")],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_returnflag string, l_linestatus string",
        ),
    }
    for name, (content, schema) in tables.items():
        spark.createDataFrame(content, schema).write.parquet(f"{folder}/{name}.parquet")
    return Surrogate(spark, str(folder))


def test_routes_are_put_together_from_steps(spark, tmp_path):
    """Previews and details joined the schedule anew for each table that they read."""
    s = small_transit(spark, tmp_path)
    steps, plain = s.routed, s.analytics
    for name in ("route_activity", "stop_activity_by_route", "route_poi_access"):
        assert rows(getattr(steps, name)) == rows(getattr(plain, name)) and getattr(steps, name).count()
    assert rows(s.routed_stops) == rows(plain.stop_context)
    for df in (steps.summary, steps.stop_context, s.routed_stops):
        assert not any("lineitem" in file or "orders" in file for file in df.inputFiles())
    assert any("lineitem" in file for file in plain.stop_context.inputFiles())
