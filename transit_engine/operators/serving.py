"""The ranked, per-route and per-city queries a dashboard asks for.

Each takes analytics tables and, where a report is per city, ``city=``: one city gives a sorted
top-k, none gives the same report for every city at once. Null order is explicit and the unique
key is the last sort column, so every limit is repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transit_engine.constants import (
    CATALOG_LIMIT,
    CITIES,
    DETAIL_STOPS,
    PREVIEW_STOPS,
    ROUTE_LIMIT,
    STOP_LIMIT,
)
from transit_engine.operators.access import ACCESS_COLUMNS
from transit_engine.operators.keyed import best_per_key, top_rows
from transit_engine.operators.ranked import in_order, sort_columns


# Sort keys; a leading minus sorts downwards.
ORDER = {
    "top_stops_activity": [
        "-avg_daily_stop_events", "-trip_count", "-poi_count_within_400m", "stop_id",
    ],
    "top_stops_poi": [
        "-poi_count_within_400m", "-food_poi_count_within_400m", "stop_id",
    ],
    "top_routes_activity": [
        "-avg_daily_stop_events", "-stop_event_count", "-distinct_trip_count",
        "route_id",
    ],
    "top_routes_poi": ["-total_poi_access", "-avg_poi_access_per_stop", "route_id"],
    "road_coverage_report": ["-coverage_pct", "-total_length_km", "highway"],
    "amenity_mix": ["-amenity_count", "poi_group"],
    "route_mode_mix": ["-stop_event_count", "route_type"],
    "route_catalog": [
        "-avg_daily_stop_events", "-stop_event_count",
        "route_short_name", "route_long_name", "route_id",
    ],
    "route_top_stops": [
        "-avg_daily_stop_events", "-trip_count", "-poi_count_within_400m", "stop_id",
    ],
    "busiest_stop": ["-avg_daily_stop_events", "-trip_count", "stop_id"],
    "busiest_route": ["-avg_daily_stop_events", "-stop_event_count", "route_id"],
}
ORDER["poi_leader"] = ORDER["top_stops_poi"]


def top_stops_activity(busiest: DataFrame, limit: int = STOP_LIMIT, city: str | None = None):
    return top_rows(busiest, ORDER["top_stops_activity"], limit, city)


def top_stops_poi(access: DataFrame, limit: int = STOP_LIMIT, city: str | None = None):
    return top_rows(access, ORDER["top_stops_poi"], limit, city)


def top_routes_activity(activity: DataFrame, limit: int = ROUTE_LIMIT, city: str | None = None):
    return top_rows(activity, ORDER["top_routes_activity"], limit, city)


def top_routes_poi(access: DataFrame, limit: int = ROUTE_LIMIT, city: str | None = None):
    return top_rows(access, ORDER["top_routes_poi"], limit, city)


def road_coverage_report(coverage: DataFrame, city: str | None = None) -> DataFrame:
    return top_rows(coverage, ORDER["road_coverage_report"], None, city)


def amenity_mix(pois: DataFrame, city: str | None = None) -> DataFrame:
    counts = pois.groupBy("city", "poi_group").agg(F.count(F.lit(1)).alias("amenity_count"))
    return top_rows(counts, ORDER["amenity_mix"], None, city)


def route_mode_mix(activity: DataFrame, city: str | None = None) -> DataFrame:
    counts = activity.groupBy("city", "route_type").agg(
        F.count(F.lit(1)).alias("route_count"),
        F.coalesce(F.sum("stop_event_count"), F.lit(0)).alias("stop_event_count"),
    )
    return top_rows(counts, ORDER["route_mode_mix"], None, city)


def route_catalog(activity: DataFrame, limit: int = CATALOG_LIMIT, city: str | None = None):
    return top_rows(activity, ORDER["route_catalog"], limit, city)


def route_summary(activity: DataFrame, poi_access: DataFrame) -> DataFrame:
    measures = [
        "stop_count", "total_poi_access", "avg_poi_access_per_stop", "max_poi_access_at_stop",
        "stops_near_hospital", "stops_near_grocery", "stops_near_park",
    ]
    return activity.join(
        poi_access.select("city", "route_id", *measures), ["city", "route_id"], "left"
    )


def route_stop_context(by_route: DataFrame, access: DataFrame) -> DataFrame:
    return by_route.join(
        access.select("city", "stop_id", *ACCESS_COLUMNS), ["city", "stop_id"], "left"
    ).select(*by_route.columns, *ACCESS_COLUMNS)


def route_top_stops(context: DataFrame, limit: int = PREVIEW_STOPS) -> DataFrame:
    """The first stops of each route, with their ``stop_rank``."""
    keys = ["city", "route_id"]
    return best_per_key(context, keys, ORDER["route_top_stops"], limit, rank="stop_rank")


def _stop_lists(top_stops: DataFrame) -> DataFrame:
    """The ranked stops of each route as one array; its length is at most the rank limit."""
    content = [name for name in top_stops.columns if name not in ("city", "route_id")]
    ordered = F.array_sort(F.collect_list(F.struct("stop_rank", *[
        name for name in content if name != "stop_rank"
    ])))
    return top_stops.groupBy("city", "route_id").agg(ordered.alias("stops"))


def route_preview(
    summary: DataFrame, context: DataFrame, stop_limit: int = PREVIEW_STOPS
) -> DataFrame:
    """Per route its summary and the array of its first stops, empty if it has none."""
    lists = _stop_lists(route_top_stops(context, stop_limit))
    described = summary.select("city", "route_id", F.struct(*summary.columns).alias("summary"))
    return described.join(lists, ["city", "route_id"], "left").select(
        "city", "route_id", "summary",
        F.coalesce("stops", F.array().cast(lists.schema["stops"].dataType)).alias("stops"),
    )


def route_shape_points(shapes: DataFrame, routes: DataFrame) -> DataFrame:
    """The points of the given routes (city, route_id), one or a few, in drawing order."""
    return (
        shapes.join(routes, ["city", "route_id"], "left_semi")
        .select(
            "city", "route_id", "shape_id", "shape_pt_sequence", "shape_pt_lat", "shape_pt_lon"
        )
        .orderBy("city", "route_id", "shape_id", "shape_pt_sequence")
    )


_PATH = ["city", "route_id", "shape_id"]


def route_path_points(shapes: DataFrame) -> DataFrame:
    """The points of every path of at least two points, one row per point.

    The bulk form of ``route_paths``: shapes of any length stay rows.
    """
    drawn = shapes.groupBy(*_PATH).agg(F.count(F.lit(1)).alias("points")).where("points >= 2")
    return shapes.join(drawn.drop("points"), _PATH, "left_semi").select(
        *_PATH, "shape_pt_sequence", F.col("shape_pt_lon").alias("lon"),
        F.col("shape_pt_lat").alias("lat"),
    )


PIECE_POINTS = 1000


def route_path_pieces(
    shapes: DataFrame, piece_points: int = PIECE_POINTS, stretches: int | None = None
) -> DataFrame:
    """Every path as numbered pieces of at most ``piece_points`` points of ``[lon, lat]``.

    A piece begins with the point that the one before ends with, so pieces drawn one by one give the
    line, and no value grows with a shape. Points are numbered by stretches of their order, so that
    no task holds a shape. Paths of one point are dropped.
    """
    order = ["shape_pt_sequence", "shape_pt_lon", "shape_pt_lat"]
    numbered = in_order(shapes.select(*_PATH, *order), _PATH, order, "_number", stretches=stretches)
    place, step = F.col("_number") - 1, piece_points - 1
    own = F.floor(place / step)
    # A point between two pieces ends the one and begins the other.
    pieces = F.when((place % step == 0) & (place > 0), F.array(own - 1, own)).otherwise(F.array(own))
    point = F.struct("_number", "shape_pt_lon", "shape_pt_lat")
    cut = (
        numbered.select("*", F.explode(pieces).alias("piece"))
        .groupBy(*_PATH, "piece").agg(F.array_sort(F.collect_list(point)).alias("points"))
        .where(F.size("points") >= 2)
    )
    path = F.transform("points", lambda p: F.array(p["shape_pt_lon"], p["shape_pt_lat"]))
    return cut.select(*_PATH, F.col("piece").cast("int").alias("piece"), path.alias("path"))


def route_paths(shapes: DataFrame) -> DataFrame:
    """Per shape the ``[lon, lat]`` list in sequence order, paths of one point dropped.

    Meant for the shapes of selected routes, which a map draws as one line each; shapes of any
    length are what ``route_path_pieces`` is for.
    """
    point = F.struct("shape_pt_sequence", "shape_pt_lon", "shape_pt_lat")
    ordered = F.array_sort(F.collect_list(point))
    lines = shapes.groupBy(*_PATH).agg(ordered.alias("points")).where(F.size("points") >= 2)
    path = F.transform("points", lambda p: F.array(p["shape_pt_lon"], p["shape_pt_lat"]))
    return lines.select(*_PATH, path.alias("path"))


def route_detail_parts(
    summary: DataFrame,
    context: DataFrame,
    shapes: DataFrame,
    wanted: DataFrame,
    stop_limit: int = DETAIL_STOPS,
    piece_points: int = PIECE_POINTS,
) -> DataFrame:
    """``route_detail`` for routes of any size, as rows.

    Part 0 of a route has its summary and stops, every further part one piece of one path (shape,
    number of the piece, points). A row is bounded by the limits of stops and points.
    """
    keys = ["city", "route_id"]

    def only_wanted(df: DataFrame) -> DataFrame:
        return df.join(wanted.select(*keys), keys, "left_semi")

    summary = only_wanted(summary)
    heads = route_preview(summary, only_wanted(context), stop_limit)
    # A route without a summary has no part; its points are left out before they are put together.
    known = shapes.join(summary.select(*keys), keys, "left_semi")
    order = ["shape_id", "piece"]
    numbered = in_order(route_path_pieces(known, piece_points), keys, order, "part")
    parts = numbered.withColumn("part", F.col("part").cast("int"))
    return heads.withColumn("part", F.lit(0)).unionByName(parts, allowMissingColumns=True).select(
        *keys, "part", "summary", "stops", "shape_id", "piece", "path"
    )


def route_detail(
    summary: DataFrame,
    context: DataFrame,
    shapes: DataFrame,
    wanted: DataFrame,
    stop_limit: int = DETAIL_STOPS,
) -> DataFrame:
    """Summary, stops and paths of the ``wanted`` (city, route_id) rows.

    A route that does not exist has no row. The semi-joins with the wanted routes come first, so
    only their stops and points are ranked and put together.
    """
    keys = ["city", "route_id"]

    def only_wanted(df: DataFrame) -> DataFrame:
        return df.join(wanted.select(*keys), keys, "left_semi")

    previews = route_preview(only_wanted(summary), only_wanted(context), stop_limit)
    lines = route_paths(only_wanted(shapes)).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("shape_id", "path"))).alias("paths")
    )
    return previews.join(lines, keys, "left").select(
        *keys, "summary", "stops",
        F.coalesce("paths", F.array().cast(lines.schema["paths"].dataType)).alias("paths"),
    )


def city_overview(
    stops: DataFrame, route_activity: DataFrame, stop_activity: DataFrame, access: DataFrame
) -> DataFrame:
    """The headline numbers of each city; a table without rows for it counts as 0."""
    names = ["total_stops", "total_routes", "total_stop_events", "daily", "with_poi", "poi_sum"]

    def part(df: DataFrame, **measures: Column) -> DataFrame:
        sums = df.groupBy("city").agg(*[m.alias(name) for name, m in measures.items()])
        return sums.select(
            "city", *[F.col(n) if n in measures else F.lit(None).alias(n) for n in names]
        )

    rows = F.count(F.lit(1))
    stacked = (
        part(stops, total_stops=rows)
        .unionByName(part(route_activity, total_routes=rows))
        .unionByName(
            part(
                stop_activity,
                total_stop_events=F.sum("trip_count"),
                daily=F.sum("avg_daily_stop_events"),
            )
        )
        .unionByName(part(access, with_poi=rows, poi_sum=F.sum("poi_count_within_400m")))
    )
    zero = F.lit(0)
    merged = stacked.groupBy("city").agg(*[F.coalesce(F.sum(n), zero).alias(n) for n in names])
    return merged.select(
        "city", "total_stops", "total_routes", "total_stop_events",
        F.round("daily", 2).alias("avg_daily_stop_events"),
        F.col("with_poi").alias("stops_with_poi_context"),
        F.round(F.col("poi_sum") / F.nullif("total_stops", zero), 2).alias(
            "avg_poi_access_per_stop"
        ),
    )


def busiest_stop(enriched: DataFrame) -> DataFrame:
    return best_per_key(enriched, ["city"], ORDER["busiest_stop"], 1).select(
        "city", "stop_name", "trip_count", "avg_daily_stop_events"
    )


def busiest_route(activity: DataFrame) -> DataFrame:
    return best_per_key(activity, ["city"], ORDER["busiest_route"], 1).select(
        "city", "route_id", "route_short_name", "route_long_name", "stop_event_count",
        "avg_daily_stop_events",
    )


def poi_leader(access: DataFrame) -> DataFrame:
    return best_per_key(access, ["city"], ORDER["poi_leader"], 1).select(
        "city", "stop_name", "poi_count_within_400m", "food_poi_count_within_400m",
        "critical_service_poi_count_within_400m", "park_poi_count_within_400m", "poi_categories",
    )


def city_dimension(spark) -> DataFrame:
    """The configured cities: names, map centre and what is available for them."""
    return spark.createDataFrame(
        CITIES,
        "city string, display_name string, latitude double, longitude double, zoom double, "
        "supports_batch boolean, supports_live boolean",
    )


def city_comparison(
    overview: DataFrame, stop: DataFrame, route: DataFrame, leader: DataFrame
) -> DataFrame:
    """Every configured city with its overview and leaders as structs (null without data)."""

    def nested(df: DataFrame, name: str) -> DataFrame:
        content = [c for c in df.columns if c != "city"]
        return df.select("city", F.struct(*content).alias(name))

    names = city_dimension(overview.sparkSession).select("city", "display_name")
    return (
        names.join(overview, "city", "left")
        .join(nested(stop, "busiest_stop"), "city", "left")
        .join(nested(route, "busiest_route"), "city", "left")
        .join(nested(leader, "poi_leader"), "city", "left")
        .na.fill(0, [name for name in overview.columns if name != "city"])
    )


def section_list(
    report: DataFrame, order: Sequence[str], name: str
) -> DataFrame:
    """A report as one sorted array per city; it holds all the rows that the report has.

    The report brings its own limit, or has a row per class or type.
    """
    content = [c for c in report.columns if c != "city"]
    place = Window.partitionBy("city").orderBy(*sort_columns(order))
    ranked = report.withColumn("position", F.row_number().over(place))
    rows = F.array_sort(F.collect_list(F.struct("position", *content)))
    return ranked.groupBy("city").agg(rows.alias(name))


def records_normalise(df: DataFrame) -> DataFrame:
    """Lower-case column names; NaN becomes null."""
    floating = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return df.select(*[
        (F.when(~F.isnan(F.col(f"`{name}`")), F.col(f"`{name}`")) if name in floating
         else F.col(f"`{name}`")).alias(name.lower())
        for name in df.columns
    ])
