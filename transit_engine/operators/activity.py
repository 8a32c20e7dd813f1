"""Stop and route activity from the schedule.

``schedule_events`` is the one join over the large stop_times table; every measure aggregates it
by ids first and joins names afterwards, which gives the same result because stops and routes
have unique keys. Days per service are attached to trips, not to stop times. A trip that holds
much of the stop_times is split by adaptive execution (the other side has one row per key), and
partial aggregation sits directly above the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.operators.ranked import written

ROUTE_NAMES = ["route_short_name", "route_long_name", "route_type"]
SENT_CITIES = 10_000  # cities whose feed days are sent to the rows instead of joined


def schedule_events(
    stop_times: DataFrame, trips: DataFrame, service_days: DataFrame
) -> DataFrame:
    """One row per stop event: (city, trip_id, stop_id, route_id, active_service_days).

    A service without any running date counts as one day, also where the trip names no service.
    """
    dated_trips = (
        trips.select("city", "trip_id", "route_id", "service_id")
        .join(service_days, ["city", "service_id"], "left")
        .select(
            "city", "trip_id", "route_id",
            F.coalesce("active_service_days", F.lit(1).cast("long")).alias("active_service_days"),
        )
    )
    return stop_times.select("city", "trip_id", "stop_id").join(dated_trips, ["city", "trip_id"])


def _with_daily_average(activity: DataFrame, feed_days: DataFrame) -> DataFrame:
    """Replace the day sum by the average per feed day, rounded to 2 decimals.

    A join by city would put a city's rows into one task. The feed days are written, so their number
    is known, and are sent to the rows, which stay where they are.
    """
    told = written(feed_days, "feed-days")
    if told.count() <= SENT_CITIES:
        told = F.broadcast(told)
    average = F.round(F.col("service_days") / F.coalesce("feed_days", F.lit(1).cast("long")), 2)
    return (
        activity.join(told, "city", "left")
        .withColumn("avg_daily_stop_events", average)
        .drop("service_days", "feed_days")
    )


def _event_sums(count_name: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias(count_name),
        F.sum("active_service_days").alias("service_days"),
    ]


def route_stop_counts(events: DataFrame) -> DataFrame:
    """Event and day sums per route and stop: what the two stop tables are built from."""
    return events.groupBy("city", "route_id", "stop_id").agg(*_event_sums("trip_count"))


def stop_activity(events: DataFrame, feed_days: DataFrame) -> DataFrame:
    """``events`` are schedule events or, already counted, ``route_stop_counts``."""
    if "service_days" in events.columns:
        sums = [F.sum(name).alias(name) for name in ("trip_count", "service_days")]
    else:
        sums = _event_sums("trip_count")
    return _with_daily_average(events.groupBy("city", "stop_id").agg(*sums), feed_days)


def stop_activity_enriched(stops: DataFrame, activity: DataFrame) -> DataFrame:
    """Activity of the stops that have a clean stop row."""
    return activity.join(stops, ["city", "stop_id"]).select(
        "city", "stop_id", "stop_name", "stop_lat", "stop_lon", "trip_count",
        "avg_daily_stop_events", "location_type", "parent_station",
    )


def running_trips(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """The trips that stop anywhere: (city, trip_id, route_id)."""
    stopping = stop_times.select("city", "trip_id").distinct()
    return trips.select("city", "trip_id", "route_id").join(stopping, ["city", "trip_id"])


def route_activity(
    counts: DataFrame, trips: DataFrame, routes: DataFrame, feed_days: DataFrame
) -> DataFrame:
    """``counts`` are ``route_stop_counts``, ``trips`` the ``running_trips``.

    The counts have a row per route and stop, the trips a row per trip, so no count here has to
    tell values apart: stop_times is neither joined again nor multiplied.
    """
    per_route = counts.groupBy("city", "route_id").agg(
        F.sum("trip_count").alias("stop_event_count"),
        F.count("stop_id").alias("distinct_stop_count"),
        F.sum("service_days").alias("service_days"),
    )
    per_route = per_route.join(
        trips.groupBy("city", "route_id").agg(F.count("trip_id").alias("distinct_trip_count")),
        ["city", "route_id"],
    )
    named = _with_daily_average(per_route, feed_days).join(routes, ["city", "route_id"])
    return named.select(
        "city", "route_id", *ROUTE_NAMES, "stop_event_count", "distinct_trip_count",
        "distinct_stop_count", "avg_daily_stop_events",
    )


def stop_activity_by_route(
    counts: DataFrame, routes: DataFrame, stops: DataFrame, feed_days: DataFrame
) -> DataFrame:
    """``counts`` are ``route_stop_counts``."""
    places = stops.select("city", "stop_id", "stop_name", "stop_lat", "stop_lon")
    named = (
        _with_daily_average(counts, feed_days)
        .join(routes, ["city", "route_id"])
        .join(places, ["city", "stop_id"])
    )
    return named.select(
        "city", "route_id", *ROUTE_NAMES, "stop_id", "stop_name", "stop_lat", "stop_lon",
        "trip_count", "avg_daily_stop_events",
    )


def route_shapes(trips: DataFrame, routes: DataFrame, shapes: DataFrame) -> DataFrame:
    """Points of every shape that a route's trips use."""
    used = trips.select("city", "route_id", "shape_id").dropna(subset=["shape_id"]).distinct()
    return (
        used.join(routes, ["city", "route_id"])
        .join(shapes, ["city", "shape_id"])
        .select(
            "city", "route_id", *ROUTE_NAMES, "shape_id", "shape_pt_sequence", "shape_pt_lat",
            "shape_pt_lon",
        )
    )


# The single-city generation of the same tables: no city column, no daily average.


def stop_activity_raw(stop_times: DataFrame) -> DataFrame:
    """Rows per stop straight from stop_times: no trips join and no null filter."""
    return stop_times.groupBy("stop_id").agg(F.count(F.lit(1)).alias("trip_count"))


def single_city_stop_activity_enriched(stops: DataFrame, activity: DataFrame) -> DataFrame:
    return activity.join(stops, "stop_id").select(
        "stop_id", "stop_name", "stop_lat", "stop_lon", "trip_count", "location_type",
        "parent_station",
    )


def single_city_route_activity(
    stop_times: DataFrame, trips: DataFrame, routes: DataFrame
) -> DataFrame:
    events = stop_times.select("trip_id", "stop_id").join(
        trips.select("trip_id", "route_id"), "trip_id"
    )
    counts = events.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("stop_event_count"),
        F.count_distinct("trip_id").alias("distinct_trip_count"),
        F.count_distinct("stop_id").alias("distinct_stop_count"),
    )
    return counts.join(routes, "route_id").select(
        "route_id", *ROUTE_NAMES, "stop_event_count", "distinct_trip_count", "distinct_stop_count"
    )


def single_city_stop_activity_by_route(
    stop_times: DataFrame, trips: DataFrame, routes: DataFrame, stops: DataFrame
) -> DataFrame:
    events = stop_times.select("trip_id", "stop_id").join(
        trips.select("trip_id", "route_id"), "trip_id"
    )
    counts = events.groupBy("route_id", "stop_id").agg(F.count(F.lit(1)).alias("trip_count"))
    return (
        counts.join(routes, "route_id")
        .join(stops, "stop_id")
        .select(
            "route_id", "route_short_name", "route_long_name", "stop_id", "stop_name",
            "stop_lat", "stop_lon", "trip_count",
        )
    )


def single_city_route_shapes(trips: DataFrame, routes: DataFrame, shapes: DataFrame) -> DataFrame:
    used = trips.select("route_id", "shape_id").dropna(subset=["shape_id"]).distinct()
    return (
        used.join(routes, "route_id")
        .join(shapes, "shape_id")
        .select(
            "route_id", *ROUTE_NAMES, "shape_id", "shape_pt_sequence", "shape_pt_lat",
            "shape_pt_lon",
        )
    )
