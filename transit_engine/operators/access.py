"""What lies near transit: points of interest around stops, roads around stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.constants import (
    CRITICAL_GROUPS,
    HOSPITAL_CATEGORIES,
    POI_BOX_DEG,
    POI_GROUPS,
    POI_RADIUS_M,
    ROAD_BOX_DEG,
    ROAD_RADIUS_M,
    SCHOOL_CATEGORIES,
)
from transit_engine.operators.activity import ROUTE_NAMES
from transit_engine.operators.around import BLOCK_ROWS, around
from transit_engine.operators.range_join import SPLIT_ROWS, Reach, near_any

ACCESS_COUNTS = [
    "poi_count_within_400m", "food_poi_count_within_400m",
    "critical_service_poi_count_within_400m", "park_poi_count_within_400m",
]
ACCESS_DISTANCES = [
    "nearest_school_m", "nearest_hospital_m", "nearest_grocery_m", "nearest_park_m",
]
ACCESS_COLUMNS = [*ACCESS_COUNTS, *ACCESS_DISTANCES, "poi_categories"]

_STOP_POSITION = ["stop_lat", "stop_lon"]
# Clean points of interest have one of these categories, so a set of them fits one long.
_CATEGORIES = sorted(POI_GROUPS)


def _category_bit(category: Column) -> Column:
    bits = [F.lit(item) for i, name in enumerate(_CATEGORIES) for item in (name, 1 << i)]
    return F.try_element_at(F.create_map(*bits), category).cast("long")


def _category_text(bits: Column) -> Column:
    names = [
        F.when(bits.bitwiseAND(F.lit(1 << i).cast("long")) != 0, name)
        for i, name in enumerate(_CATEGORIES)
    ]
    return F.concat_ws(", ", *names)


def stop_poi_access(
    stops: DataFrame, pois: DataFrame, exact: bool = False, split_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Counts and nearest distances of the points of interest within 400 m of each stop.

    Stops without any are absent. Copies are merged before the distance join: places at one
    position become one row with their numbers, and stops at one position are looked up once.
    ``around`` then adds up what lies near them without making the pairs (the category set is a bit
    mask).
    """
    category, group = F.col("poi_category"), F.col("poi_group")

    def number(which: Column) -> Column:
        return F.count(F.when(which, F.lit(1)))

    def any_of(which: Column) -> Column:
        return F.coalesce(F.bool_or(which), F.lit(False))

    measures = [
        F.count(F.lit(1)),
        number(group == "food"),
        number(group.isin(CRITICAL_GROUPS)),
        number(group == "park"),
        any_of(category.isin(SCHOOL_CATEGORIES)),
        any_of(category.isin(HOSPITAL_CATEGORIES)),
        any_of(group == "grocery"),
        any_of(group == "park"),
        F.coalesce(F.bit_or(_category_bit(category)), F.lit(0).cast("long")),
    ]
    places = pois.groupBy("city", "lat", "lon").agg(
        *[measure.alias(name) for measure, name in zip(measures, ACCESS_COLUMNS, strict=True)]
    )
    positions = stops.select("city", *_STOP_POSITION).distinct()
    measured = around(
        positions, places, _STOP_POSITION, ["lat", "lon"], Reach(POI_RADIUS_M, POI_BOX_DEG, exact),
        ACCESS_COUNTS, ACCESS_DISTANCES, "poi_categories", split_rows=split_rows,
    )
    return stops.join(measured, ["city", *_STOP_POSITION]).select(
        "city", "stop_id", "stop_name", *_STOP_POSITION, *ACCESS_COUNTS, *ACCESS_DISTANCES,
        _category_text(F.col("poi_categories")).alias("poi_categories"),
    )


def busiest_stops_with_poi_context(enriched: DataFrame, access: DataFrame) -> DataFrame:
    """Stop activity with its surroundings; stops without any keep nulls, not zeros."""
    return enriched.join(
        access.select("city", "stop_id", *ACCESS_COLUMNS), ["city", "stop_id"], "left"
    ).select(
        "city", "stop_id", "stop_name", *_STOP_POSITION, "trip_count", "avg_daily_stop_events",
        *ACCESS_COLUMNS,
    )


def route_poi_access(by_route: DataFrame, access: DataFrame) -> DataFrame:
    """Surroundings of each route's stops.

    The total counts a stop without places as 0, the mean is over stops with places only. Rows
    of ``by_route`` are unique per route and stop, so plain counts replace distinct ones.
    """
    joined = by_route.select("city", "route_id", *ROUTE_NAMES, "stop_id").join(
        access.select("city", "stop_id", ACCESS_COUNTS[0], *ACCESS_DISTANCES),
        ["city", "stop_id"],
        "left",
    )
    places = F.col(ACCESS_COUNTS[0])
    return joined.groupBy("city", "route_id", *ROUTE_NAMES).agg(
        F.count("stop_id").alias("stop_count"),
        F.sum(F.coalesce(places, F.lit(0))).alias("total_poi_access"),
        F.round(F.avg(places), 2).alias("avg_poi_access_per_stop"),
        F.max(places).alias("max_poi_access_at_stop"),
        F.count("nearest_hospital_m").alias("stops_near_hospital"),
        F.count("nearest_grocery_m").alias("stops_near_grocery"),
        F.count("nearest_park_m").alias("stops_near_park"),
    )


def transit_road_coverage(
    roads: DataFrame, stops: DataFrame, exact: bool = False, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Share of the road segments of each class whose midpoint has a stop within 200 m.

    A class without any covered segment keeps nulls.
    """
    segments = roads.select("city", "osm_id", "highway", "mid_lat", "mid_lon", "length_m")
    positions = stops.select("city", *_STOP_POSITION).distinct()
    covered = near_any(
        segments, positions, ["mid_lat", "mid_lon"], _STOP_POSITION,
        Reach(ROAD_RADIUS_M, ROAD_BOX_DEG, exact), split_rows=split_rows,
    )

    def by_class(rows: DataFrame, segments_name: str, length_name: str) -> DataFrame:
        return rows.groupBy("city", "highway").agg(
            F.count(F.lit(1)).alias(segments_name),
            F.round(F.sum("length_m") / 1000, 2).alias(length_name),
        )

    total = by_class(segments, "total_road_segments", "total_length_km")
    near = by_class(covered, "road_segments_near_transit", "covered_length_km")
    share = F.col("road_segments_near_transit") / F.col("total_road_segments") * 100
    return total.join(near, ["city", "highway"], "left").select(
        "city", "highway", "total_road_segments", "road_segments_near_transit",
        F.round(share, 2).alias("coverage_pct"), "total_length_km", "covered_length_km",
    )
