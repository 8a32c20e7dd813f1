"""The composed answers of the dashboard: one city, all cities, one route."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transit_engine.constants import CATALOG_LIMIT, PREVIEW_STOPS, ROUTE_LIMIT, STOP_LIMIT
from transit_engine.operators import serving


@dataclass(frozen=True)
class AnalyticsTables:
    """What the serving queries read: clean stops and points of interest, analytics tables."""

    stops: DataFrame
    pois: DataFrame
    stop_activity: DataFrame
    stop_activity_enriched: DataFrame
    route_activity: DataFrame
    stop_activity_by_route: DataFrame
    route_shapes: DataFrame
    stop_poi_access: DataFrame
    busiest_stops_with_poi_context: DataFrame
    route_poi_access: DataFrame
    transit_road_coverage: DataFrame

    def of_city(self, city: str) -> AnalyticsTables:
        """The same tables of one city; on tables partitioned by city only its folders are read."""
        only = {name: df.where(F.col("city") == city) for name, df in self.__dict__.items()}
        return AnalyticsTables(**only)

    @property
    def summary(self) -> DataFrame:
        return serving.route_summary(self.route_activity, self.route_poi_access)

    @property
    def stop_context(self) -> DataFrame:
        return serving.route_stop_context(self.stop_activity_by_route, self.stop_poi_access)


def city_overview(tables: AnalyticsTables) -> DataFrame:
    return serving.city_overview(
        tables.stops, tables.route_activity, tables.stop_activity, tables.stop_poi_access
    )


def city_comparison(tables: AnalyticsTables) -> DataFrame:
    return serving.city_comparison(
        city_overview(tables),
        serving.busiest_stop(tables.stop_activity_enriched),
        serving.busiest_route(tables.route_activity),
        serving.poi_leader(tables.stop_poi_access),
    )


DASHBOARD_SECTIONS = {
    "top_stops_by_activity": "top_stops_activity",
    "top_stops_by_poi": "top_stops_poi",
    "top_routes_by_activity": "top_routes_activity",
    "top_routes_by_poi": "top_routes_poi",
    "road_coverage": "road_coverage_report",
    "amenity_mix": "amenity_mix",
    "route_mode_mix": "route_mode_mix",
}


def dashboard_reports(
    tables: AnalyticsTables, stop_limit: int = STOP_LIMIT, route_limit: int = ROUTE_LIMIT
) -> dict[str, DataFrame]:
    """The dashboard's sections, each a report for every city."""
    return {
        "top_stops_by_activity": serving.top_stops_activity(
            tables.busiest_stops_with_poi_context, stop_limit
        ),
        "top_stops_by_poi": serving.top_stops_poi(tables.stop_poi_access, stop_limit),
        "top_routes_by_activity": serving.top_routes_activity(tables.route_activity, route_limit),
        "top_routes_by_poi": serving.top_routes_poi(tables.route_poi_access, route_limit),
        "road_coverage": serving.road_coverage_report(tables.transit_road_coverage),
        "amenity_mix": serving.amenity_mix(tables.pois),
        "route_mode_mix": serving.route_mode_mix(tables.route_activity),
    }


def city_dashboard(
    tables: AnalyticsTables, stop_limit: int = STOP_LIMIT, route_limit: int = ROUTE_LIMIT
) -> DataFrame:
    """One row per configured city: its overview and the sections as sorted arrays.

    Every array comes from a report with a limit, or from one with a row per road class, place
    group or route type, so a row stays small however large the tables are.
    """
    overview = city_comparison(tables)
    content = [name for name in overview.columns if name != "city"]
    board = overview.select("city", F.struct(*content).alias("overview"))
    for name, report in dashboard_reports(tables, stop_limit, route_limit).items():
        lists = serving.section_list(report, serving.ORDER[DASHBOARD_SECTIONS[name]], name)
        board = board.join(lists, "city", "left")
    return board


def featured_routes(tables: AnalyticsTables) -> DataFrame:
    """The first route of each city's catalog."""
    return serving.route_catalog(tables.route_activity, 1).select("city", "route_id")


def city_snapshot(
    tables: AnalyticsTables,
    stop_limit: int = STOP_LIMIT,
    route_limit: int = ROUTE_LIMIT,
    catalog_limit: int = CATALOG_LIMIT,
) -> dict[str, DataFrame]:
    """Dashboard, route catalog, previews of all routes and the detail of the featured route.

    The parts stay separate tables: a city's previews have a row per route and are not put into
    one value.
    """
    context = tables.stop_context
    return {
        "dashboard": city_dashboard(tables, stop_limit, route_limit),
        "routes": serving.route_catalog(tables.route_activity, catalog_limit),
        "route_previews": serving.route_preview(tables.summary, context, PREVIEW_STOPS),
        "featured_route_detail": serving.route_detail(
            tables.summary, context, tables.route_shapes, featured_routes(tables)
        ),
    }


def bootstrap_snapshot(
    tables: AnalyticsTables,
    stop_limit: int = STOP_LIMIT,
    route_limit: int = ROUTE_LIMIT,
    catalog_limit: int = CATALOG_LIMIT,
) -> dict[str, DataFrame]:
    """All cities: dimension, comparison, snapshots, and featured details keyed ``city:route``."""
    parts = city_snapshot(tables, stop_limit, route_limit, catalog_limit)
    featured = parts["featured_route_detail"]
    return {
        "cities": serving.city_dimension(tables.stops.sparkSession),
        "comparison": city_comparison(tables),
        **parts,
        "featured_previews": featured.withColumn("key", F.concat_ws(":", "city", "route_id")),
    }
