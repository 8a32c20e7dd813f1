"""Raw text tables -> typed clean tables.

A raw table either carries a ``city`` column (several cities stacked) or is given one with
``city=``. Text that is no number becomes null under ``try_cast`` and the null filter decides.
Where a key repeats, the row that is smallest by its other columns stays, so that a rerun gives
the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.constants import POI_GROUPS, POI_TAGS, ROAD_CLASSES
from transit_engine.functions.text import blank_to_null, lookup
from transit_engine.operators.keyed import one_per_key


def _text(name: str) -> Column:
    return F.trim(F.col(name).cast("string")).alias(name)


def _number(name: str, kind: str) -> Column:
    return F.col(name).cast("string").try_cast(kind).alias(name)


def _city(city: str | None) -> Column:
    return (F.col("city") if city is None else F.lit(city)).alias("city")


def optional_string_column(df: DataFrame, name: str) -> Column:
    """The trimmed column where the feed has it, else a typed null."""
    if name in df.columns:
        return _text(name)
    return F.lit(None).cast("string").alias(name)


def clean_stops(raw: DataFrame, city: str | None = None) -> DataFrame:
    typed = raw.select(
        _city(city), _text("stop_id"), _text("stop_name"), _number("stop_lat", "double"),
        _number("stop_lon", "double"), _number("location_type", "int"), _text("parent_station"),
    )
    kept = typed.dropna(subset=["stop_id", "stop_name", "stop_lat", "stop_lon"])
    return one_per_key(kept, ["city", "stop_id"])


def clean_routes(raw: DataFrame, city: str | None = None) -> DataFrame:
    typed = raw.select(
        _city(city), _text("route_id"), _text("route_short_name"), _text("route_long_name"),
        _number("route_type", "int"),
    )
    return one_per_key(typed.dropna(subset=["route_id"]), ["city", "route_id"])


def clean_trips(raw: DataFrame, city: str | None = None) -> DataFrame:
    typed = raw.select(
        _city(city), _text("route_id"), _text("service_id"), _text("trip_id"),
        _number("direction_id", "int"), _text("shape_id"),
        optional_string_column(raw, "direction"), _number("wheelchair_accessible", "int"),
        optional_string_column(raw, "schd_trip_id"),
    )
    return one_per_key(typed.dropna(subset=["route_id", "trip_id"]), ["city", "trip_id"])


def clean_stop_times(raw: DataFrame, city: str | None = None) -> DataFrame:
    """Times stay text, since a schedule may run past 24:00:00. Repeats are kept."""
    typed = raw.select(
        _city(city), _text("trip_id"), _text("arrival_time"), _text("departure_time"),
        _text("stop_id"), _number("stop_sequence", "int"),
    )
    return typed.dropna(subset=["trip_id", "stop_id", "stop_sequence"])


def clean_shapes(raw: DataFrame, city: str | None = None) -> DataFrame:
    typed = raw.select(
        _city(city), _text("shape_id"), _number("shape_pt_lat", "double"),
        _number("shape_pt_lon", "double"), _number("shape_pt_sequence", "int"),
    )
    return typed.dropna(subset=["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"])


def clean_roads(raw: DataFrame, city: str | None = None) -> DataFrame:
    """The class filter comes before the one-per-key step; a missing length stays."""
    ends = ["start_lat", "start_lon", "end_lat", "end_lon", "mid_lat", "mid_lon"]
    typed = raw.select(
        _city(city), F.col("osm_id").cast("string").alias("osm_id"), _text("name"),
        _text("highway"), *[_number(name, "double") for name in ends],
        _number("length_m", "double"),
    )
    kept = typed.dropna(subset=["osm_id", *ends]).where(F.col("highway").isin(ROAD_CLASSES))
    return one_per_key(kept, ["city", "osm_id"])


def clean_pois(raw: DataFrame, city: str | None = None) -> DataFrame:
    typed = raw.select(
        _city(city), F.col("osm_id").cast("string").alias("osm_id"), _text("name"),
        _text("tag_key"), _text("tag_value"), _text("poi_category"),
        _number("lat", "double"), _number("lon", "double"),
    )
    kept = typed.dropna(subset=["osm_id", "poi_category", "lat", "lon"]).where(
        F.col("poi_category").isin(list(POI_GROUPS))
    )
    grouped = one_per_key(kept, ["city", "osm_id"]).withColumn(
        "poi_group", poi_group(F.col("poi_category"))
    )
    return grouped.select(
        "city", "osm_id", "name", "tag_key", "tag_value", "poi_category", "poi_group", "lat", "lon"
    )


def poi_group(category: Column) -> Column:
    return F.coalesce(lookup(POI_GROUPS, category), F.lit("other"))


def derive_road_segments(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Street-network edges (u, v) and node positions -> one road segment per edge.

    ``name`` and ``highway`` are arrays where several ways share an edge; the first entry counts.
    An edge whose node is unknown stays, with null positions. The midpoint is the arithmetic mean.
    """

    def position(end: str, prefix: str) -> DataFrame:
        return nodes.select(
            "city", F.col("node_id").alias(end), F.col("lat").alias(f"{prefix}_lat"),
            F.col("lon").alias(f"{prefix}_lon"),
        )

    def first(name: str) -> Column:
        is_array = edges.schema[name].dataType.typeName() == "array"
        return F.try_element_at(F.col(name), F.lit(1)) if is_array else F.col(name)

    placed = edges.join(position("u", "start"), ["city", "u"], "left").join(
        position("v", "end"), ["city", "v"], "left"
    )
    return placed.select(
        "city", F.col("osmid").alias("osm_id"), first("name").alias("name"),
        first("highway").alias("highway"), "start_lat", "start_lon", "end_lat", "end_lon",
        ((F.col("start_lat") + F.col("end_lat")) / 2).alias("mid_lat"),
        ((F.col("start_lon") + F.col("end_lon")) / 2).alias("mid_lon"),
        F.col("length").alias("length_m"),
    )


def classify_pois(features: DataFrame) -> DataFrame:
    """Map features -> points of interest by the first tag, in order, with an accepted value."""
    present = [key for key in POI_TAGS if key in features.columns]
    accepted = {key: F.col(key).isin(POI_TAGS[key]) for key in present}
    nothing = F.lit(None).cast("string")
    tag_key = F.coalesce(*[F.when(accepted[key], F.lit(key)) for key in present], nothing)
    tag_value = F.coalesce(*[F.when(accepted[key], F.col(key)) for key in present], nothing)
    return (
        features.withColumn("tag_key", tag_key)
        .withColumn("tag_value", tag_value)
        .where(blank_to_null(F.col("tag_key")).isNotNull())
        .select(
            "city", F.col("osm_id").cast("string").alias("osm_id"), "name", "tag_key",
            "tag_value", F.col("tag_value").alias("poi_category"), "lat", "lon",
        )
    )
