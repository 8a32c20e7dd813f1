"""The aggregations behind the dashboard's charts, lists and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.functions import tiers
from transit_engine.functions.geo import finite
from transit_engine.functions.text import (
    blank_to_null,
    category_labels,
    daily_needs_text,
    route_label,
    split_categories,
    stop_display_label,
)
from transit_engine.operators.access import ACCESS_COUNTS
from transit_engine.operators.keyed import best_per_key
from transit_engine.operators.ranked import in_order, sort_columns, written

_ROUTE = ["city", "route_id"]
SENT_GROUPS = 10_000  # groups that are sent to the rows instead of joined


def service_value(avg_daily: Column, trip_count: Column) -> Column:
    """Daily service, or the trip count where there is no daily figure (null or 0)."""
    return F.coalesce(F.nullif(avg_daily, F.lit(0.0)), trip_count.cast("double"), F.lit(0.0))


def route_stop_rollup(context: DataFrame) -> DataFrame:
    """A route's stops merged by name (by id where there is none).

    Trips and daily service add up, place counts take the maximum, categories are united and
    ``stop_instances`` counts the platforms. The other fields come from the first stop in the
    route's own order.
    """
    name = F.coalesce(blank_to_null(F.col("stop_name")), F.col("stop_id"))
    zero = F.lit(0)
    own_order = F.struct(
        (-F.coalesce("avg_daily_stop_events", F.lit(0.0))).alias("daily"),
        (-F.coalesce("trip_count", zero)).alias("trips"),
        (-F.coalesce(ACCESS_COUNTS[0], F.lit(-1))).alias("places"),
        F.col("stop_id").alias("id"),
    )
    first = F.min_by(F.struct("stop_id", "stop_name", "stop_lat", "stop_lon"), own_order)
    # One entry per distinct category list, of which a stop name has as many as platforms.
    lists = F.collect_set(split_categories(F.col("poi_categories")))
    merged = context.groupBy(*_ROUTE, name.alias("stop_key")).agg(
        first.alias("first"),
        F.count(zero).alias("stop_instances"),
        F.sum(F.coalesce("trip_count", zero)).alias("trip_count"),
        F.round(F.sum(F.coalesce("avg_daily_stop_events", F.lit(0.0))), 2).alias(
            "avg_daily_stop_events"
        ),
        *[F.max(F.coalesce(count, zero)).alias(count) for count in ACCESS_COUNTS],
        F.array_sort(F.array_distinct(F.flatten(lists))).alias("categories"),
    )
    return merged.select(
        *_ROUTE, "stop_key", "first.*", "stop_instances", "trip_count", "avg_daily_stop_events",
        *ACCESS_COUNTS, F.array_join("categories", ", ").alias("poi_categories"),
    )


ROLLUP_ACCESS_ORDER = ["-poi_count_within_400m", "-trip_count", "stop_key"]


def share_of_total(
    report: DataFrame,
    value: str,
    order: Sequence[str],
    by: Sequence[str] = ("city",),
    stretches: int | None = None,
) -> DataFrame:
    """Each row's share of its group with its running start and end.

    Running sums are made by stretches of the order, so a group may hold any number of rows; its
    total is aggregated and sent back like the maxima of ``ratio_to_max``.
    """
    number = F.coalesce(F.col(value), F.lit(0))
    running = in_order(report, by, order, "_rank", {"_running": number}, stretches)
    totals = report.groupBy(*by).agg(F.sum(number).alias("_total"))
    return (
        _per_group(running, totals, by)
        .withColumn("share", tiers.share_of(number, F.col("_total")))
        .withColumn("share_start", tiers.share_of(F.col("_running") - number, F.col("_total")))
        .withColumn("share_end", tiers.share_of(F.col("_running"), F.col("_total")))
        .select(*report.columns, "share", "share_start", "share_end")
    )


def _per_group(df: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with what was worked out for their group.

    The groups are written, so their number is known: up to ``SENT_GROUPS`` of them are sent to the
    rows, which stay where they are; more are joined, and a large group is split by adaptive
    execution.
    """
    told = written(groups, "groups")
    few = told.count() <= SENT_GROUPS
    named = told.withColumnsRenamed({name: f"_of_{name}" for name in by})
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in by]
    return df.join(F.broadcast(named) if few else named, same).drop(*[f"_of_{name}" for name in by])


def ratio_to_max(
    df: DataFrame, value: Column, by: Sequence[str] = ("city",), name: str = "ratio"
) -> DataFrame:
    """value / largest value of the group, 0 if that is 0.

    The maximum is aggregated and joined back: a window over a city would put all of that
    city's rows into one task.
    """
    scored = df.withColumn("_value", value)
    largest = scored.groupBy(*by).agg(F.max("_value").alias("_max"))
    return (
        _per_group(scored, largest, by)
        .withColumn(name, tiers.share_of(F.col("_value"), F.col("_max")))
        .drop("_value", "_max")
    )


def availability_tier(df: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    score = service_value(F.col("avg_daily_stop_events"), F.col("trip_count"))
    return ratio_to_max(df, score, by).withColumn("tier", tiers.availability_tier(F.col("ratio")))


def lens_score_tier(df: DataFrame, lens: str, by: Sequence[str] = ("city",)) -> DataFrame:
    score = tiers.lens_score(
        lens, F.col("poi_count_within_400m"), F.col("avg_daily_stop_events"), F.col("trip_count")
    )
    return ratio_to_max(df, score, by).withColumn("tier", tiers.lens_score_tier(F.col("ratio")))


def trip_count_tier(df: DataFrame) -> DataFrame:
    return df.withColumn("tier", tiers.trip_count_tier(F.col("trip_count")))


def finite_coordinates(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Rows that can be put on a map; a null coordinate cannot."""
    return df.where(finite(F.col(lon)) & finite(F.col(lat)))


def route_extent(context: DataFrame, path_points: DataFrame) -> DataFrame:
    """Bounding box, centre, span and zoom of each route's stops and path points."""
    stops = context.select(*_ROUTE, F.col("stop_lon").alias("lon"), F.col("stop_lat").alias("lat"))
    points = stops.unionByName(path_points.select(*_ROUTE, "lon", "lat"))
    box = finite_coordinates(points, "lon", "lat").groupBy(*_ROUTE).agg(
        F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
    )
    span = F.greatest(F.col("max_lon") - F.col("min_lon"), F.col("max_lat") - F.col("min_lat"))
    return (
        box.withColumn("latitude", (F.col("min_lat") + F.col("max_lat")) / 2)
        .withColumn("longitude", (F.col("min_lon") + F.col("max_lon")) / 2)
        .withColumn("span", span)
        .withColumn("zoom", tiers.zoom_bucket(F.col("span")))
    )


def display_topk(
    report: DataFrame, order: Sequence[str], limit: int, by: Sequence[str] = ("city",)
) -> DataFrame:
    """The first rows of a report for each city (or route), with their ``position``."""
    return best_per_key(report, by, order, limit, rank="position")


def stop_labels(stops: DataFrame, limit: int = 4) -> DataFrame:
    """Display texts of stops that carry access measures."""
    labels = category_labels(F.col("poi_categories"), limit)
    return stops.withColumn("category_labels", F.array_join(labels, ", ")).withColumn(
        "daily_needs", daily_needs_text(*[F.col(name) for name in ACCESS_COUNTS[1:]])
    )


def stop_display_labels(rollup: DataFrame) -> DataFrame:
    return rollup.withColumn(
        "display_label",
        stop_display_label(
            F.coalesce(blank_to_null(F.col("stop_name")), F.col("stop_key")),
            F.col("stop_instances"),
        ),
    )


def route_labels(routes: DataFrame) -> DataFrame:
    return routes.withColumn(
        "route_label",
        route_label(F.col("route_short_name"), F.col("route_long_name"), F.col("route_id")),
    )


def stops_over_threshold(
    enriched: DataFrame, min_trips: int = 1000, limit: int = 300
) -> DataFrame:
    """Per city the busiest stops with at least ``min_trips`` stop events."""
    busy = enriched.where(F.col("trip_count") >= min_trips)
    return best_per_key(busy, ["city"], ["-trip_count", "stop_id"], limit)


def stop_kpis(shown: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Stops shown, highest and mean activity of a list of stops."""
    return shown.groupBy(*by).agg(
        F.count(F.lit(1)).alias("stops_shown"),
        F.max("trip_count").alias("max_trip_count"),
        F.round(F.avg("trip_count"), 1).alias("mean_trip_count"),
    )


def route_options(by_route: DataFrame) -> DataFrame:
    """The distinct routes with the label they are chosen by."""
    names = by_route.select(*_ROUTE, "route_short_name", "route_long_name").distinct()
    label = F.concat(
        F.coalesce("route_short_name", "route_id"), F.lit(" - "),
        F.coalesce("route_long_name", F.lit("")),
    )
    return names.withColumn("route_label", label)


def route_stops_over_threshold(by_route: DataFrame, min_trips: int = 0) -> DataFrame:
    """Stops of each route with at least ``min_trips`` stop events, by trips downwards."""
    shown = by_route.where(F.col("trip_count") >= min_trips)
    return shown.orderBy("city", "route_id", *sort_columns(["-trip_count", "stop_id"]))


def live_route_options(vehicles: DataFrame) -> DataFrame:
    """Distinct route ids, blanks left out."""
    return (
        vehicles.select("city", "route_id")
        .where(blank_to_null(F.col("route_id")).isNotNull())
        .distinct()
    )


def live_kpis(vehicles: DataFrame, route_id: str | None = None) -> DataFrame:
    """Vehicles shown under the route filter, and active routes regardless of it."""
    shown = F.lit(True) if not route_id else F.col("route_id") == route_id
    return vehicles.groupBy("city").agg(
        F.count(F.when(shown, 1)).alias("vehicles_shown"),
        F.count_distinct(blank_to_null(F.col("route_id"))).alias("routes_active"),
    )
