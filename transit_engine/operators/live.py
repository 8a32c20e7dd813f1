"""Agency feeds -> the one live record schema (``schemas.LIVE_RECORD``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.constants import (
    CTA_BUS_TIME_FORMATS,
    CTA_INACTIVE_ROUTE_MESSAGE,
    CTA_TRAIN_TIME_FORMATS,
    CTA_ZONE,
)
from transit_engine.functions.text import blank_to_null, joined
from transit_engine.functions.times import parse_iso_timestamp, parse_local_timestamp
from transit_engine.sources.payloads import poll_order

# What says in which order rows arrived; carried along beside the record.
ARRIVAL = ["payload_id", "line_no", "item_no"]


def _double(column: Column) -> Column:
    return column.try_cast("double")


def _nothing(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _record(rows: DataFrame, arrival: Sequence[str], **fields: Column) -> DataFrame:
    """The 18 fields in contract order, behind the arrival columns; unplaced rows are dropped."""
    names = [
        "city", "vehicle_id", "route_id", "route_label", "trip_id", "stop_id", "label",
        "latitude", "longitude", "bearing", "speed", "current_status", "occupancy_status",
        "direction_id", "route_type", "updated_at", "feed_timestamp", "source",
    ]
    fields["feed_timestamp"] = fields["updated_at"]
    records = rows.select(*arrival, *[fields[name].alias(name) for name in names])
    return records.dropna(subset=["latitude", "longitude"])


def normalize_mbta(scanned: DataFrame) -> DataFrame:
    item, attributes = F.col("vehicle"), F.col("vehicle.attributes")
    route = F.col("route.attributes")

    def related(name: str) -> Column:
        return F.col(f"vehicle.relationships.{name}.data.id")

    return _record(
        scanned,
        ["payload_id", "item_no"],
        city=F.lit("boston"),
        # A vehicle without an id is named after the missing value, as in the feed's own client.
        vehicle_id=F.coalesce(item["id"], F.lit("None")),
        route_id=related("route"),
        route_label=joined(" - ", route["short_name"], route["long_name"]),
        trip_id=related("trip"),
        stop_id=related("stop"),
        label=attributes["label"],
        latitude=_double(attributes["latitude"]),
        longitude=_double(attributes["longitude"]),
        bearing=_double(attributes["bearing"]),
        speed=_double(attributes["speed"]),
        current_status=attributes["current_status"],
        occupancy_status=attributes["occupancy_status"],
        direction_id=attributes["direction_id"].try_cast("int"),
        route_type=route["type"].try_cast("int"),
        updated_at=parse_iso_timestamp(attributes["updated_at"]),
        source=F.lit("mbta_v3"),
    )


def normalize_cta_bus(vehicles: DataFrame, routes: DataFrame) -> DataFrame:
    """``routes`` has one name per route id (``payloads.bus_routes``)."""
    named = vehicles.where(blank_to_null(F.trim("vid")).isNotNull()).join(routes, "rt", "left")
    route_id = blank_to_null(F.col("rt"))
    place = F.coalesce(blank_to_null(F.col("rtnm")), blank_to_null(F.col("des")))
    return _record(
        named,
        ["payload_id", "item_no"],
        city=F.lit("chicago"),
        vehicle_id=F.concat(F.lit("bus-"), F.trim("vid")),
        route_id=route_id,
        route_label=joined(" - ", route_id, place),
        trip_id=blank_to_null(F.col("tatripid")),
        stop_id=_nothing(),
        label=F.trim("vid"),
        latitude=_double(F.col("lat")),
        longitude=_double(F.col("lon")),
        bearing=_double(F.col("hdg")),
        speed=_double(F.col("spd")),
        current_status=F.when(F.lower("dly") == "true", "STOPPED_AT"),
        occupancy_status=_nothing(),
        direction_id=_nothing("int"),
        route_type=F.lit(3),
        updated_at=parse_local_timestamp(F.col("tmstmp"), CTA_BUS_TIME_FORMATS, CTA_ZONE),
        source=F.lit("cta_bus_tracker"),
    )


def normalize_cta_train(trains: DataFrame) -> DataFrame:
    """Line names are title-cased per blank-separated word."""
    run = blank_to_null(F.trim("rn"))
    line = F.concat(F.initcap("line_name"), F.lit(" Line"))
    digits = F.col("trDr").rlike("^[0-9]+$")
    return _record(
        trains.where(run.isNotNull()),
        ARRIVAL,
        city=F.lit("chicago"),
        vehicle_id=F.concat(F.lit("train-"), run),
        route_id=F.lower("line_name"),
        route_label=F.concat_ws(" - ", line, blank_to_null(F.col("destNm"))),
        trip_id=_nothing(),
        stop_id=blank_to_null(F.col("nextStpId")),
        label=run,
        latitude=_double(F.col("lat")),
        longitude=_double(F.col("lon")),
        bearing=_double(F.col("heading")),
        speed=_nothing("double"),
        current_status=F.when(F.col("isApp") == "1", "INCOMING_AT").otherwise("IN_TRANSIT_TO"),
        occupancy_status=_nothing(),
        direction_id=F.when(digits, F.col("trDr").try_cast("int")),
        route_type=F.lit(1),
        updated_at=parse_local_timestamp(F.col("prdt"), CTA_TRAIN_TIME_FORMATS, CTA_ZONE),
        source=F.lit("cta_train_tracker"),
    )


def bus_feed_errors(errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split feed errors: (routes that are merely inactive, messages that reject the response)."""
    route = blank_to_null(F.col("rt"))
    inactive = route.isNotNull() & F.coalesce(
        F.col("msg") == CTA_INACTIVE_ROUTE_MESSAGE, F.lit(False)
    )
    return (
        errors.where(inactive).select("payload_id", "rt"),
        errors.where(~inactive).select("payload_id", "rt", "msg"),
    )


def accepted_vehicles(vehicles: DataFrame, rejected: DataFrame) -> DataFrame:
    """Vehicles of the responses that no error rejects."""
    return vehicles.join(rejected.select("payload_id"), "payload_id", "left_anti")


def active_bus_routes(vehicles: DataFrame, inactive: DataFrame) -> DataFrame:
    """Routes with a vehicle in a later response than the last that calls them inactive."""

    def last(df: DataFrame, name: str) -> DataFrame:
        named = df.where(blank_to_null(F.col("rt")).isNotNull())
        return named.groupBy("rt").agg(F.max(F.struct(*poll_order())).alias(name))

    both = last(vehicles, "seen").join(last(inactive, "gone"), "rt", "left")
    return both.where(F.col("gone").isNull() | (F.col("seen") > F.col("gone"))).select("rt")


def dedupe_latest(records: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """One record per vehicle of a city: the latest by time, on a tie the one that arrived later.

    A record without any time never replaces another, so among such records the first stays.
    An aggregate, so a vehicle with very many records is reduced before the shuffle.
    """
    time = F.coalesce("updated_at", "feed_timestamp")
    undated = time.isNull()
    arrived: list[Column] = []
    for name in arrival:
        arrived += poll_order() if name == "payload_id" else [F.col(name)]
    dated_order = F.when(~undated, F.struct(time.alias("time"), *arrived))
    latest = F.max_by(F.struct(*records.columns), dated_order)
    first = F.min_by(F.struct(*records.columns), F.struct(*arrived))
    return (
        records.groupBy("city", "vehicle_id")
        .agg(F.coalesce(latest, first).alias("row"))
        .select("row.*")
    )


def live_union(*feeds: DataFrame | None) -> DataFrame:
    """The feeds that are there, stacked; a feed that failed is simply left out."""
    present = [feed for feed in feeds if feed is not None]
    if not present:
        raise ValueError("no feed available")
    stacked = present[0]
    for feed in present[1:]:
        stacked = stacked.unionByName(feed, allowMissingColumns=True)
    return stacked
