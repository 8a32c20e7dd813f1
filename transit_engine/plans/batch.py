"""The batch build: clean tables of all cities -> the nine analytics tables, in one run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from transit_engine.operators import access, activity, cleaning, service_calendar
from transit_engine.operators.ranked import written
from transit_engine.schemas import ANALYTICS, CLEAN
from transit_engine.sinks.datasets import write_dataset
from transit_engine.sources.files import (
    read_dataset,
    scan_calendar,
    scan_clean,
    scan_gtfs,
    scan_osm,
)

_CLEANERS = {
    "stops": cleaning.clean_stops,
    "routes": cleaning.clean_routes,
    "trips": cleaning.clean_trips,
    "stop_times": cleaning.clean_stop_times,
    "shapes": cleaning.clean_shapes,
    "roads": cleaning.clean_roads,
    "pois": cleaning.clean_pois,
}


@dataclass(frozen=True)
class TransitTables:
    """The clean tables plus the running dates; every city is in every table."""

    stops: DataFrame
    routes: DataFrame
    trips: DataFrame
    stop_times: DataFrame
    shapes: DataFrame
    roads: DataFrame
    pois: DataFrame
    active_dates: DataFrame

    @property
    def service_days(self) -> DataFrame:
        return service_calendar.active_service_day_counts(self.active_dates)

    @property
    def feed_days(self) -> DataFrame:
        return service_calendar.total_feed_days(self.active_dates)

    @property
    def events(self) -> DataFrame:
        return activity.schedule_events(self.stop_times, self.trips, self.service_days)


def clean_all(
    spark: SparkSession, gtfs: dict[str, str], osm: dict[str, str], clean_root: str
) -> dict[str, int]:
    """Raw files of all cities -> the clean tables below ``clean_root``; returns row counts."""
    counts: dict[str, int] = {}
    for table, clean in _CLEANERS.items():
        is_map = table in ("roads", "pois")
        raw = scan_osm(spark, osm, table) if is_map else scan_gtfs(spark, gtfs, table)
        counts |= write_dataset(clean(raw), clean_root, table, list(gtfs))
    dates = service_calendar.active_service_dates(*scan_calendar(spark, gtfs))
    return counts | write_dataset(dates, clean_root, "active_service_dates", list(gtfs))


def read_clean(spark: SparkSession, clean_root: str) -> TransitTables:
    dates = read_dataset(
        spark, clean_root, "active_service_dates",
        "city string, service_id string, service_date date",
    )
    return TransitTables(
        active_dates=dates, **{table: scan_clean(spark, clean_root, table) for table in CLEAN}
    )


def build_analytics(
    spark: SparkSession, tables: TransitTables, root: str, cities: Sequence[str] = ()
) -> dict[str, int]:
    """Write the nine tables below ``root`` and return their row counts.

    ``cities`` are those the run is for; what one of them no longer has is cleared.

    A table that others build on is written once and read back, which also cuts its lineage.
    The two stop tables come from one counted join of stop_times, kept as ``route_stop_counts``.
    """
    counts: dict[str, int] = {}

    def save(df: DataFrame, dataset: str) -> DataFrame:
        counts.update(write_dataset(df, root, dataset, cities))
        return read_dataset(spark, root, dataset, ANALYTICS[dataset])

    working = "route_stop_counts"
    write_dataset(activity.route_stop_counts(tables.events), root, working, cities)
    visits = read_dataset(
        spark, root, working,
        "city string, route_id string, stop_id string, trip_count long, service_days long",
    )
    feed_days = written(tables.feed_days, "feed-days")
    stop_activity = save(activity.stop_activity(visits, feed_days), "stop_activity")
    enriched = save(
        activity.stop_activity_enriched(tables.stops, stop_activity), "stop_activity_enriched"
    )
    trips = activity.running_trips(tables.stop_times, tables.trips)
    save(activity.route_activity(visits, trips, tables.routes, feed_days), "route_activity")
    by_route = save(
        activity.stop_activity_by_route(visits, tables.routes, tables.stops, feed_days),
        "stop_activity_by_route",
    )
    save(activity.route_shapes(tables.trips, tables.routes, tables.shapes), "route_shapes")
    poi_access = save(access.stop_poi_access(tables.stops, tables.pois), "stop_poi_access")
    save(
        access.busiest_stops_with_poi_context(enriched, poi_access),
        "busiest_stops_with_poi_context",
    )
    save(access.route_poi_access(by_route, poi_access), "route_poi_access")
    save(access.transit_road_coverage(tables.roads, tables.stops), "transit_road_coverage")
    return counts
