"""Every operator as a named query over a folder of test data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transit_engine.catalog.surrogate import Surrogate
from transit_engine.constants import POI_BOX_DEG, POI_RADIUS_M
from transit_engine.functions.geo import haversine_m
from transit_engine.functions.text import (
    amenity_group_label,
    blank_to_null,
    route_type_label,
    vehicle_status_text,
)
from transit_engine.operators import (
    access,
    activity,
    cleaning,
    presentation,
    service_calendar,
    serving,
)
from transit_engine.operators.range_join import Reach, near_pairs
from transit_engine.plans import snapshot
from transit_engine.session import configure

_BUILDERS: dict[str, Callable[[Surrogate], DataFrame]] = {}


def query(build: Callable[[Surrogate], DataFrame]) -> Callable[[Surrogate], DataFrame]:
    """Register a function under its own name, without a ``_query`` that sets it apart."""
    _BUILDERS[build.__name__.removesuffix("_query")] = build
    return build


def portable(df: DataFrame) -> DataFrame:
    """Dates as text and instants as epoch microseconds: one reading in every engine."""

    def column(field):
        kind = field.dataType.typeName()
        if kind == "timestamp":
            return F.unix_micros(field.name).alias(field.name)
        return F.col(field.name).cast("string") if kind == "date" else F.col(field.name)

    return df.select(*[column(field) for field in df.schema])


def metres(df: DataFrame, *names: str) -> DataFrame:
    """Distances to the millimetre."""
    return df.withColumns({name: F.round(name, 3) for name in names})


def access_metres(df: DataFrame) -> DataFrame:
    return metres(df, *access.ACCESS_DISTANCES)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build):
        return lambda spark, sf_dir: portable(build(Surrogate(configure(spark), sf_dir)))

    return {name: runner(build) for name, build in _BUILDERS.items()}


# Cleaning.


@query
def clean_stops(s: Surrogate) -> DataFrame:
    return cleaning.clean_stops(s.raw_stops)


@query
def clean_routes(s: Surrogate) -> DataFrame:
    return cleaning.clean_routes(s.raw_routes)


@query
def clean_trips(s: Surrogate) -> DataFrame:
    return cleaning.clean_trips(s.raw_trips)


@query
def optional_string_column(s: Surrogate) -> DataFrame:
    raw = s.raw_trips
    return raw.select(
        "trip_id",
        cleaning.optional_string_column(raw, "direction"),
        cleaning.optional_string_column(raw, "schd_trip_id"),
    )


@query
def clean_stop_times(s: Surrogate) -> DataFrame:
    return cleaning.clean_stop_times(s.raw_stop_times)


@query
def clean_shapes(s: Surrogate) -> DataFrame:
    return cleaning.clean_shapes(s.raw_shapes)


@query
def clean_roads(s: Surrogate) -> DataFrame:
    return cleaning.clean_roads(s.raw_roads)


@query
def clean_pois(s: Surrogate) -> DataFrame:
    return cleaning.clean_pois(s.raw_pois)


@query
def poi_group(s: Surrogate) -> DataFrame:
    category = F.trim("poi_category")
    return (
        s.raw_pois.groupBy(category.alias("poi_category"))
        .agg(F.count(F.lit(1)).alias("places"))
        .withColumn("poi_group", cleaning.poi_group(F.col("poi_category")))
    )


@query
def derive_road_segments(s: Surrogate) -> DataFrame:
    return cleaning.derive_road_segments(s.street_edges, s.street_nodes)


@query
def classify_pois(s: Surrogate) -> DataFrame:
    return cleaning.classify_pois(s.map_features)


# Service calendar.


@query
def service_calendar_expand(s: Surrogate) -> DataFrame:
    return service_calendar.service_calendar_expand(s.calendar)


@query
def service_exceptions(s: Surrogate) -> DataFrame:
    return service_calendar.service_exceptions(s.calendar_dates)


@query
def active_service_dates(s: Surrogate) -> DataFrame:
    return s.active_dates


@query
def active_service_day_counts(s: Surrogate) -> DataFrame:
    return s.service_days


@query
def total_feed_days(s: Surrogate) -> DataFrame:
    return s.feed_days


# Batch analytics.


@query
def stop_activity(s: Surrogate) -> DataFrame:
    return s.stop_activity


@query
def stop_activity_enriched(s: Surrogate) -> DataFrame:
    return s.stop_activity_enriched


@query
def route_activity(s: Surrogate) -> DataFrame:
    return s.route_activity


@query
def stop_activity_by_route(s: Surrogate) -> DataFrame:
    return s.stop_activity_by_route


@query
def route_shapes(s: Surrogate) -> DataFrame:
    return s.route_shapes


@query
def stop_poi_access(s: Surrogate) -> DataFrame:
    return access_metres(s.stop_poi_access)


@query
def busiest_stops_with_poi_context(s: Surrogate) -> DataFrame:
    return access_metres(s.busiest_stops_with_poi_context)


@query
def route_poi_access(s: Surrogate) -> DataFrame:
    return s.route_poi_access


@query
def transit_road_coverage(s: Surrogate) -> DataFrame:
    return s.transit_road_coverage


# The single-city generation, run over all rows as if they were one city's. Keys there are
# unique once the city is part of them.


def _one_city(df: DataFrame, *keys: str) -> DataFrame:
    return df.withColumns({k: F.concat_ws("/", "city", k) for k in keys if k in df.columns}).drop(
        "city"
    )


_IDS = ("stop_id", "route_id", "trip_id", "shape_id")


@query
def stop_activity_raw(s: Surrogate) -> DataFrame:
    return activity.stop_activity_raw(s.raw_stop_times)


@query
def legacy_stop_activity_enriched(s: Surrogate) -> DataFrame:
    counts = activity.stop_activity_raw(_one_city(s.stop_times, *_IDS))
    return activity.single_city_stop_activity_enriched(_one_city(s.stops, *_IDS), counts)


@query
def legacy_route_activity(s: Surrogate) -> DataFrame:
    return activity.single_city_route_activity(
        _one_city(s.stop_times, *_IDS), _one_city(s.trips, *_IDS), _one_city(s.routes, *_IDS)
    )


@query
def legacy_stop_activity_by_route(s: Surrogate) -> DataFrame:
    return activity.single_city_stop_activity_by_route(
        _one_city(s.stop_times, *_IDS), _one_city(s.trips, *_IDS), _one_city(s.routes, *_IDS),
        _one_city(s.stops, *_IDS),
    )


@query
def legacy_route_shapes(s: Surrogate) -> DataFrame:
    trips = s.trips.where(F.col("shape_id").isNotNull())
    return activity.single_city_route_shapes(
        _one_city(trips, *_IDS), _one_city(s.routes, *_IDS), _one_city(s.shapes, *_IDS)
    )


# Distances.


@query
def haversine_distance(s: Surrogate) -> DataFrame:
    """Length of every road segment's straight line."""
    segments = cleaning.derive_road_segments(s.street_edges, s.street_nodes)
    ends = [F.col(n) for n in ("start_lat", "start_lon", "end_lat", "end_lon")]
    return metres(segments.select("*", haversine_m(*ends).alias("distance_m")), "distance_m").select(
        "city", "osm_id", "start_lat", "start_lon", "end_lat", "end_lon", "distance_m"
    )


@query
def bbox_distance_join(s: Surrogate) -> DataFrame:
    # Folded per stop where the pairs are measured, so that none of them is given out.
    pairs = near_pairs(
        s.stops.select("city", "stop_id", "stop_lat", "stop_lon"),
        s.pois.select("city", "osm_id", "lat", "lon"),
        ["stop_lat", "stop_lon"], ["lat", "lon"], Reach(POI_RADIUS_M, POI_BOX_DEG), per=["stop_id"],
    )
    return metres(pairs, "nearest_m", "farthest_m")


# Serving: reports for every city at once.


@query
def top_stops_activity(s: Surrogate) -> DataFrame:
    return access_metres(serving.top_stops_activity(s.busiest_stops_with_poi_context))


@query
def top_stops_poi(s: Surrogate) -> DataFrame:
    return access_metres(serving.top_stops_poi(s.stop_poi_access))


@query
def top_routes_activity(s: Surrogate) -> DataFrame:
    return serving.top_routes_activity(s.route_activity)


@query
def top_routes_poi(s: Surrogate) -> DataFrame:
    return serving.top_routes_poi(s.route_poi_access)


@query
def road_coverage_report(s: Surrogate) -> DataFrame:
    return serving.road_coverage_report(s.transit_road_coverage)


@query
def amenity_mix(s: Surrogate) -> DataFrame:
    return serving.amenity_mix(s.pois)


@query
def route_mode_mix(s: Surrogate) -> DataFrame:
    return serving.route_mode_mix(s.route_activity)


@query
def route_catalog(s: Surrogate) -> DataFrame:
    return serving.route_catalog(s.route_activity)


@query
def route_summary(s: Surrogate) -> DataFrame:
    return s.analytics.summary


@query
def route_stop_context(s: Surrogate) -> DataFrame:
    return access_metres(s.analytics.stop_context)


@query
def route_top_stops(s: Surrogate) -> DataFrame:
    return access_metres(serving.route_top_stops(s.analytics.stop_context))


def _listed(df: DataFrame, *keys: str) -> DataFrame:
    """The array of stops as rows again; a route without stops keeps one row."""
    return df.select(*keys, F.explode_outer("stops").alias("stop")).select(
        *keys, "stop.stop_rank", "stop.stop_id", "stop.trip_count"
    )


@query
def route_preview(s: Surrogate) -> DataFrame:
    previews = serving.route_preview(s.routed.summary, s.routed_stops)
    flat = previews.select(
        "city", "route_id", "summary.stop_event_count", "summary.total_poi_access", "stops"
    )
    return _listed(flat, "city", "route_id", "stop_event_count", "total_poi_access")


@query
def route_shape_points(s: Surrogate) -> DataFrame:
    """The points of the first route of Boston's catalog."""
    first = serving.route_catalog(s.route_activity, 1, "boston").select("city", "route_id")
    return serving.route_shape_points(s.route_shapes, first)


@query
def route_path_points(s: Surrogate) -> DataFrame:
    return serving.route_path_points(s.route_shapes)


@query
def route_paths(s: Surrogate) -> DataFrame:
    """The lists of ``[lon, lat]`` as rows with their place."""
    return serving.route_paths(s.route_shapes).select(
        "city", "route_id", "shape_id", F.posexplode("path").alias("place", "point")
    ).select(
        "city", "route_id", "shape_id", "place", F.col("point")[0].alias("lon"),
        F.col("point")[1].alias("lat"),
    )


_PIECE_POINTS = 5  # the shapes of the test tables have few points


@query
def route_path_pieces(s: Surrogate) -> DataFrame:
    """The pieces of all paths as rows with their place."""
    return serving.route_path_pieces(s.route_shapes, _PIECE_POINTS).select(
        "city", "route_id", "shape_id", "piece", F.posexplode("path").alias("place", "point")
    ).select(
        "city", "route_id", "shape_id", "piece", "place", F.col("point")[0].alias("lon"),
        F.col("point")[1].alias("lat"),
    )


@query
def route_detail_parts(s: Surrogate) -> DataFrame:
    """Details of all routes in bounded parts: sizes of what each part holds."""
    summary = s.routed.summary
    parts = serving.route_detail_parts(
        summary, s.routed_stops, s.route_shapes, summary, piece_points=_PIECE_POINTS
    )
    return parts.select(
        "city", "route_id", "part", F.col("summary.stop_event_count").alias("stop_event_count"),
        F.size("stops").alias("stops"), "shape_id", "piece", F.size("path").alias("points"),
    )


def _detail(s: Surrogate) -> DataFrame:
    a = s.routed
    return serving.route_detail(
        a.summary, a.stop_context, s.route_shapes, snapshot.featured_routes(a)
    )


@query
def route_detail(s: Surrogate) -> DataFrame:
    """Stops, then path points, of each city's featured route."""
    return _detail_rows(_detail(s))


def _detail_rows(detail: DataFrame) -> DataFrame:
    stops = detail.select(
        "city", "route_id", F.lit("stop").alias("part"), F.explode("stops").alias("stop")
    ).select(
        "city", "route_id", "part", F.lit("").alias("shape_id"), "stop.stop_rank",
        "stop.stop_lat", "stop.stop_lon",
    ).toDF("city", "route_id", "part", "shape_id", "position", "lat", "lon")
    paths = detail.select("city", "route_id", F.explode("paths").alias("path")).select(
        "city", "route_id", F.lit("path").alias("part"), "path.shape_id",
        F.posexplode("path.path").alias("position", "point"),
    )
    points = paths.select(
        "city", "route_id", "part", "shape_id", (F.col("position") + 1).alias("position"),
        F.col("point")[1].alias("lat"), F.col("point")[0].alias("lon"),
    )
    return stops.unionByName(points)


@query
def city_overview(s: Surrogate) -> DataFrame:
    """Read from the written tables, as a serving query is."""
    return snapshot.city_overview(s.written)


@query
def busiest_stop(s: Surrogate) -> DataFrame:
    return serving.busiest_stop(s.stop_activity_enriched)


@query
def busiest_route(s: Surrogate) -> DataFrame:
    return serving.busiest_route(s.route_activity)


@query
def poi_leader(s: Surrogate) -> DataFrame:
    return serving.poi_leader(s.stop_poi_access)


@query
def city_dimension(s: Surrogate) -> DataFrame:
    """Live vehicles seen per configured city, with its map view."""
    seen = s.live.groupBy("city").agg(F.count_distinct("vehicle_id").alias("vehicles"))
    return serving.city_dimension(s.spark).join(seen, "city", "left")


@query
def city_comparison(s: Surrogate) -> DataFrame:
    compared = snapshot.city_comparison(s.written)
    return compared.select(
        "city", "display_name", "total_stops", "total_routes", "total_stop_events",
        "avg_daily_stop_events", "stops_with_poi_context", "avg_poi_access_per_stop",
        F.col("busiest_stop.stop_name").alias("busiest_stop"),
        F.col("busiest_route.route_id").alias("busiest_route"),
        F.col("poi_leader.stop_name").alias("poi_leader"),
    )


# What identifies and what ranks a row of each dashboard section.
_SECTION_COLUMNS = {
    "top_stops_by_activity": ("stop_id", "avg_daily_stop_events"),
    "top_stops_by_poi": ("stop_id", "poi_count_within_400m"),
    "top_routes_by_activity": ("route_id", "avg_daily_stop_events"),
    "top_routes_by_poi": ("route_id", "total_poi_access"),
    "road_coverage": ("highway", "coverage_pct"),
    "amenity_mix": ("poi_group", "amenity_count"),
    "route_mode_mix": ("route_type", "stop_event_count"),
}


def _stacked(parts: list[DataFrame]) -> DataFrame:
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def _dashboard_rows(board: DataFrame) -> DataFrame:
    """(city, section, position, item, value): the arrays of a dashboard as rows."""

    def entries(section: str, item: str, value: str):
        return F.transform(
            section,
            lambda row: F.struct(
                F.lit(section).alias("section"), row["position"].alias("position"),
                row[item].cast("string").alias("item"), row[value].cast("double").alias("value"),
            ),
        )

    sections = [entries(name, *columns) for name, columns in _SECTION_COLUMNS.items()]
    return board.select("city", F.inline(F.concat(*sections)))


@query
def city_dashboard(s: Surrogate) -> DataFrame:
    return _dashboard_rows(snapshot.city_dashboard(s.written))


@query
def one_city_dashboard(s: Surrogate) -> DataFrame:
    """The dashboard of one city, from its folders alone."""
    board = snapshot.city_dashboard(s.written.of_city("boston"))
    return _dashboard_rows(board.where(F.col("city") == "boston"))


@query
def one_city_top_stops(s: Surrogate) -> DataFrame:
    top = serving.top_stops_activity(s.written.busiest_stops_with_poi_context, city="boston")
    return access_metres(top)


@query
def one_city_route_catalog(s: Surrogate) -> DataFrame:
    return serving.route_catalog(s.written.route_activity, city="boston")


def _snapshot_rows(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows per part of a snapshot: dashboard entries, catalog, previews, detail."""

    def counted(df: DataFrame, part: str) -> DataFrame:
        return df.groupBy("city").agg(F.count(F.lit(1)).alias("entries")).select(
            "city", F.lit(part).alias("part"), "entries"
        )

    return _stacked([
        counted(_dashboard_rows(parts["dashboard"]), "dashboard"),
        counted(parts["routes"], "routes"),
        counted(parts["route_previews"].select("city", F.explode("stops")), "preview_stops"),
        counted(_detail_rows(parts["featured_route_detail"]), "featured"),
    ])


@query
def city_snapshot(s: Surrogate) -> DataFrame:
    return _snapshot_rows(snapshot.city_snapshot(s.written))


@query
def bootstrap_snapshot(s: Surrogate) -> DataFrame:
    """The featured previews by their key, with their city's numbers beside them."""
    parts = snapshot.bootstrap_snapshot(s.written)
    featured = parts["featured_previews"].select(
        "city", "key", F.col("summary.stop_event_count").alias("stop_event_count"),
        F.size("stops").alias("stops"), F.size("paths").alias("paths"),
    )
    compared = parts["comparison"].select("city", "total_stops", "total_routes")
    names = parts["cities"].select("city", "display_name")
    return names.join(compared, "city").join(featured, "city")


@query
def bootstrap_contents(s: Surrogate) -> DataFrame:
    """What the bundle holds for all cities: dashboard entries, catalogs and the stops of previews."""
    parts = snapshot.bootstrap_snapshot(s.written)
    catalog = parts["routes"].select(
        "city", F.lit("routes").alias("section"), F.lit(0).alias("position"), F.col("route_id").alias("item"),
        F.col("stop_event_count").cast("double").alias("value"),
    )
    previews = parts["route_previews"].select("city", "route_id", F.explode("stops").alias("stop")).select(
        "city", F.concat(F.lit("preview:"), "route_id").alias("section"), F.col("stop.stop_rank").alias("position"),
        F.col("stop.stop_id").alias("item"), F.col("stop.trip_count").cast("double").alias("value"),
    )
    return _stacked([_dashboard_rows(parts["dashboard"]), catalog, previews])


@query
def records_normalise(s: Surrogate) -> DataFrame:
    """A whole table with warehouse-style names; NaN where a distance is missing."""
    missing = {n: F.coalesce(n, F.lit(float("nan"))) for n in access.ACCESS_DISTANCES}
    warehouse = s.stop_poi_access.withColumns(missing)
    named = warehouse.toDF(*[name.upper() for name in warehouse.columns])
    return access_metres(serving.records_normalise(named))


# Presentation.


def _rollup(s: Surrogate) -> DataFrame:
    return presentation.route_stop_rollup(s.analytics.stop_context)


@query
def route_stop_rollup(s: Surrogate) -> DataFrame:
    return _rollup(s)


@query
def share_of_total(s: Surrogate) -> DataFrame:
    shares = presentation.share_of_total(
        serving.amenity_mix(s.pois), "amenity_count", serving.ORDER["amenity_mix"]
    )
    return shares.select(
        "city", "poi_group", *[F.round(n, 6).alias(n) for n in ("share", "share_start", "share_end")]
    )


@query
def ratio_to_max(s: Surrogate) -> DataFrame:
    rated = presentation.ratio_to_max(s.route_activity, F.col("stop_event_count"))
    return rated.select(
        "city", "route_id", F.round(F.col("ratio") * 100, 6).alias("width_pct")
    )


@query
def availability_tier(s: Surrogate) -> DataFrame:
    return presentation.availability_tier(s.stop_activity_enriched).select(
        "city", "stop_id", F.round("ratio", 6).alias("ratio"), "tier"
    )


@query
def lens_score_tier(s: Surrogate) -> DataFrame:
    stops = s.busiest_stops_with_poi_context
    return _stacked([
        presentation.lens_score_tier(stops, lens).select(
            "city", "stop_id", F.lit(lens).alias("lens"), "tier"
        )
        for lens in ("service", "access")
    ])


@query
def trip_count_tier(s: Surrogate) -> DataFrame:
    """On route totals, whose size spans the steps."""
    routes = s.route_activity.withColumn("trip_count", F.col("stop_event_count") * 20)
    return presentation.trip_count_tier(routes).select("city", "route_id", "trip_count", "tier")


@query
def route_extent(s: Surrogate) -> DataFrame:
    extent = presentation.route_extent(
        s.stop_activity_by_route, serving.route_path_points(s.route_shapes)
    )
    numbers = [name for name in extent.columns if name not in ("city", "route_id", "zoom")]
    return extent.select(
        "city", "route_id", *[F.round(n, 6).alias(n) for n in numbers], "zoom"
    )


@query
def finite_coordinates(s: Surrogate) -> DataFrame:
    """Street segments; an unknown node leaves its end without a position."""
    segments = cleaning.derive_road_segments(s.street_edges, s.street_nodes)
    return presentation.finite_coordinates(segments, "end_lon", "end_lat").select(
        "city", "osm_id", "end_lon", "end_lat"
    )


@query
def display_topk(s: Surrogate) -> DataFrame:
    """First rows per city of five reports, and per route of its stops."""
    activity_order, poi_order = serving.ORDER["top_stops_activity"], serving.ORDER["top_stops_poi"]
    sections = [
        ("amenity_mix", serving.amenity_mix(s.pois), serving.ORDER["amenity_mix"], 6, "poi_group"),
        ("mode_mix", serving.route_mode_mix(s.route_activity), serving.ORDER["route_mode_mix"], 5,
         "route_type"),
        ("stops", s.busiest_stops_with_poi_context, activity_order, 8, "stop_id"),
        ("stops_poi", s.stop_poi_access, poi_order, 8, "stop_id"),
        ("routes", s.route_activity, serving.ORDER["top_routes_activity"], 8, "route_id"),
    ]
    by_city = [
        presentation.display_topk(report, order, limit).select(
            "city", F.lit(name).alias("section"), F.lit("").alias("route_id"), "position",
            F.col(item).cast("string").alias("item"),
        )
        for name, report, order, limit, item in sections
    ]
    by_route = presentation.display_topk(
        _rollup(s), presentation.ROLLUP_ACCESS_ORDER, 8, ["city", "route_id"]
    ).select("city", F.lit("route_stops").alias("section"), "route_id", "position",
             F.col("stop_key").alias("item"))
    return _stacked([*by_city, by_route])


@query
def stop_display_label(s: Surrogate) -> DataFrame:
    return presentation.stop_display_labels(_rollup(s)).select(
        "city", "route_id", "stop_key", "display_label"
    )


@query
def labels(s: Surrogate) -> DataFrame:
    """Category and daily-needs texts of stops."""
    return presentation.stop_labels(s.busiest_stops_with_poi_context).select(
        "city", "stop_id", "category_labels", "daily_needs"
    )


@query
def labels_routes(s: Surrogate) -> DataFrame:
    return presentation.route_labels(s.routes).select(
        "city", "route_id", "route_label", route_type_label(F.col("route_type")).alias("mode")
    )


@query
def labels_amenities(s: Surrogate) -> DataFrame:
    return serving.amenity_mix(s.pois).select(
        "city", amenity_group_label(F.col("poi_group")).alias("label"), "amenity_count"
    )


@query
def labels_vehicles(s: Surrogate) -> DataFrame:
    status = vehicle_status_text(F.col("current_status"), F.col("city"), F.col("route_type"))
    return s.live.select(
        "seq", F.coalesce(blank_to_null(F.col("label")), F.col("vehicle_id")).alias("vehicle"),
        status.alias("status"),
    )


_BUSY = 18


@query
def stops_over_threshold(s: Surrogate) -> DataFrame:
    shown = presentation.stops_over_threshold(s.stop_activity_enriched, min_trips=_BUSY)
    return shown.select("city", "stop_id", "stop_name", "trip_count", "stop_lat", "stop_lon")


@query
def stops_over_threshold_kpis(s: Surrogate) -> DataFrame:
    return presentation.stop_kpis(
        presentation.stops_over_threshold(s.stop_activity_enriched, min_trips=_BUSY)
    )


@query
def route_options(s: Surrogate) -> DataFrame:
    return presentation.route_options(s.stop_activity_by_route)


@query
def route_stops_over_threshold(s: Surrogate) -> DataFrame:
    """The stops with their place in the order, which stays checkable after sorting."""
    shown = presentation.route_stops_over_threshold(s.stop_activity_by_route, min_trips=2)
    place = Window.partitionBy("city", "route_id").orderBy(F.desc("trip_count"), "stop_id")
    return shown.select(
        "city", "route_id", "stop_id", "trip_count", F.row_number().over(place).alias("place")
    )


@query
def live_route_options(s: Surrogate) -> DataFrame:
    return presentation.live_route_options(s.live)


@query
def live_kpis(s: Surrogate) -> DataFrame:
    return _stacked([
        presentation.live_kpis(s.live, route).withColumn("filter", F.lit(route or "all"))
        for route in (None, "7")
    ])
