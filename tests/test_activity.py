from conftest import rows
from pyspark.sql import functions as F

from transit_engine.operators import activity


def schedule(spark):
    trips = spark.createDataFrame(
        [("b", "t1", "r1", "daily"), ("b", "t2", "r1", "never"), ("b", "t3", "r9", None),
         ("c", "t1", "r1", "daily")],
        "city string, trip_id string, route_id string, service_id string",
    )
    stop_times = spark.createDataFrame(
        [("b", "t1", "s1"), ("b", "t1", "s2"), ("b", "t1", "s1"), ("b", "t2", "s1"),
         ("b", "t3", "s3"), ("b", "t4", "s1"), ("c", "t1", "s1")],
        "city string, trip_id string, stop_id string",
    )
    days = spark.createDataFrame(
        [("b", "daily", 6)], "city string, service_id string, active_service_days long"
    )
    feed = spark.createDataFrame([("b", 4)], "city string, feed_days long")
    routes = spark.createDataFrame(
        [("b", "r1", "1", "One", 3), ("c", "r1", "1", "One", 3)],
        "city string, route_id string, route_short_name string, route_long_name string, "
        "route_type int",
    )
    return activity.schedule_events(stop_times, trips, days), feed, routes


def test_service_without_dates_counts_one_day(spark):
    events, feed, _ = schedule(spark)
    expected = [("b", "s1", 3, 3.25), ("b", "s2", 1, 1.5), ("b", "s3", 1, 0.25), ("c", "s1", 1, 1.0)]
    assert rows(activity.stop_activity(events, feed)) == expected
    counted = activity.route_stop_counts(events)
    assert rows(activity.stop_activity(counted, feed)) == expected


def test_route_activity_drops_unknown_routes(spark):
    events, feed, routes = schedule(spark)
    counts, trips = activity.route_stop_counts(events), events.select("city", "trip_id", "route_id").distinct()
    assert rows(activity.route_activity(counts, trips, routes, feed)) == [
        ("b", "r1", "1", "One", 3, 4, 2, 2, 4.75), ("c", "r1", "1", "One", 3, 1, 1, 1, 1.0),
    ]


def test_trip_with_most_stop_times_is_split(spark):
    """A third of all stop times on one trip: the join splits that partition, the result holds."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        numbers = spark.range(0, 300_000, numPartitions=12)
        trip = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
        stop_times = numbers.select(
            F.lit("b").alias("city"), trip.cast("string").alias("trip_id"),
            (F.col("id") % 70_001).cast("string").alias("stop_id"),
        )
        trips = spark.range(5000).select(
            F.lit("b").alias("city"), F.col("id").cast("string").alias("trip_id"),
            (F.col("id") % 7).cast("string").alias("route_id"), F.lit("s").alias("service_id"),
        )
        days = spark.createDataFrame(
            [("b", "s", 2)], "city string, service_id string, active_service_days long"
        )
        counts = activity.route_stop_counts(activity.schedule_events(stop_times, trips, days))
        total = counts.agg(F.sum("trip_count"), F.sum("service_days"))
        assert rows(total) == [(300_000, 600_000)]
        assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_shapes_need_a_shape_and_a_known_route(spark):
    trips = spark.createDataFrame(
        [("b", "r1", "h"), ("b", "r1", "h"), ("b", "r1", None), ("b", "r2", "h")],
        "city string, route_id string, shape_id string",
    )
    _, _, routes = schedule(spark)
    shapes = spark.createDataFrame(
        [("b", "h", 42.0, -71.0, 1), ("b", "h", 42.1, -71.1, 2)],
        "city string, shape_id string, shape_pt_lat double, shape_pt_lon double, "
        "shape_pt_sequence int",
    )
    found = activity.route_shapes(trips, routes, shapes)
    assert rows(found, "route_id", "shape_pt_sequence") == [("r1", 1), ("r1", 2)]
