"""Landed feed responses: one JSON document per row, in the column ``body``.

Every value is read as text (a number keeps its digits) and cast where it is used, so that one
odd value costs that value and not its document. Documents are exploded in place, without a shuffle
but for very large ones.
A ``payload_id`` says which response a row came from and ``item_no`` its place in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RELATION = "struct<data:struct<id:string>>"
_MBTA = f"""
    data array<struct<
        id:string,
        attributes:struct<latitude:string, longitude:string, label:string, bearing:string,
            speed:string, current_status:string, occupancy_status:string, direction_id:string,
            updated_at:string>,
        relationships:struct<route:{_RELATION}, trip:{_RELATION}, stop:{_RELATION}>>>,
    included array<struct<
        type:string, id:string,
        attributes:struct<type:string, short_name:string, long_name:string>>>
"""
_BUS_VEHICLE = (
    "vid:string, lat:string, lon:string, rt:string, des:string, dly:string, tmstmp:string, "
    "hdg:string, spd:string, tatripid:string"
)
_BUS = f"""
    `bustime-response` struct<
        vehicle:array<struct<{_BUS_VEHICLE}>>, error:string,
        routes:array<struct<rt:string, rtnm:string>>>
"""
_ERRORS = "array<struct<rt:string, msg:string>>"
_TRAINS = """
    array<struct<rn:string, lat:string, lon:string, destNm:string, nextStpId:string,
        isApp:string, trDr:string, prdt:string, heading:string>>
"""
# ``train`` is a list or a single object, so it is kept as text and parsed on its own:
# an array schema at the root of from_json takes both.
_TRAIN = "ctatt struct<errCd:string, errNm:string, route:array<struct<`@name`:string, train:string>>>"


def landed(spark, path: str) -> DataFrame:
    """Response files, one document each: ``payload_id`` is the file."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("payload_id"), F.col("value").alias("body")
    )


def poll_order() -> list[Column]:
    """The order of responses: by the number that names them, else by their name."""
    return [F.col("payload_id").try_cast("long").alias("poll"), F.col("payload_id")]


def _items(df: DataFrame, items: Column, name: str = "item") -> DataFrame:
    return df.select("payload_id", F.posexplode(items).alias("item_no", name))


# Documents of more characters look routes up by a join; in smaller ones an array search is short.
LARGE_DOCUMENT = 256_000


def scan_mbta_payload(payloads: DataFrame, large: int = LARGE_DOCUMENT) -> DataFrame:
    """One row per vehicle with the route it names, looked up in the same document.

    Where a route is listed twice the last counts. In documents of up to ``large`` characters the
    lookup is an array search within the row, without a shuffle. That takes (vehicles x routes)
    steps, so in larger ones both are rows and joined, which takes time in proportion to their number.
    """
    size = F.coalesce(F.length("body"), F.lit(0))
    return _found_in_place(payloads.where(size <= large)).unionByName(
        _found_by_join(payloads.where(size > large))
    )


def _routes_and_vehicles(payloads: DataFrame) -> DataFrame:
    return payloads.select("payload_id", F.from_json("body", _MBTA).alias("doc")).select(
        "payload_id", "doc.data",
        F.filter("doc.included", lambda item: item["type"] == "route").alias("routes"),
    )


def _found_in_place(payloads: DataFrame) -> DataFrame:
    with_route = F.transform(
        "data",
        lambda vehicle: F.struct(
            vehicle.alias("vehicle"),
            F.try_element_at(
                F.filter(
                    "routes",
                    lambda route: route["id"] == vehicle["relationships"]["route"]["data"]["id"],
                ),
                F.lit(-1),
            ).alias("route"),
        ),
    )
    return _items(_routes_and_vehicles(payloads), with_route).select(
        "payload_id", "item_no", "item.vehicle", "item.route"
    )


def _found_by_join(payloads: DataFrame) -> DataFrame:
    parsed = _routes_and_vehicles(payloads)
    routes = (
        parsed.select("payload_id", F.posexplode("routes").alias("place", "route"))
        .groupBy("payload_id", F.col("route.id").alias("route_id"))
        .agg(F.max_by("route", "place").alias("route"))
    )
    vehicles = _items(parsed, F.col("data"), "vehicle").withColumn(
        "route_id", F.col("vehicle.relationships.route.data.id")
    )
    return vehicles.join(routes, ["payload_id", "route_id"], "left").select(
        "payload_id", "item_no", "vehicle", "route"
    )


def scan_cta_bus_payload(payloads: DataFrame) -> DataFrame:
    """One row per document: its vehicles, errors and routes as arrays.

    ``error`` may be a list or one object.
    """
    response = payloads.select(
        "payload_id", F.from_json("body", _BUS)["bustime-response"].alias("response")
    )
    return response.select(
        "payload_id", F.col("response.vehicle").alias("vehicles"),
        F.from_json("response.error", _ERRORS).alias("errors"),
        F.col("response.routes").alias("routes"),
    )


def bus_vehicles(responses: DataFrame) -> DataFrame:
    return _items(responses, F.col("vehicles"), "vehicle").select(
        "payload_id", "item_no", "vehicle.*"
    )


def bus_errors(responses: DataFrame) -> DataFrame:
    return _items(responses, F.col("errors"), "error").select("payload_id", "item_no", "error.*")


def bus_routes(responses: DataFrame) -> DataFrame:
    """Route id and name; the last mention in the latest response counts."""
    named = _items(responses, F.col("routes"), "route").select("payload_id", "item_no", "route.*")
    return (
        named.where(F.nullif("rt", F.lit("")).isNotNull())
        .groupBy("rt")
        .agg(F.max_by("rtnm", F.struct(*poll_order(), "item_no")).alias("rtnm"))
    )


def scan_cta_train_payload(payloads: DataFrame) -> DataFrame:
    """One row per train with its line; a document that reports an error gives none."""
    parsed = payloads.select("payload_id", F.from_json("body", _TRAIN)["ctatt"].alias("doc"))
    lines = _items(
        parsed.where(F.coalesce("doc.errCd", F.lit("0")) == "0"), F.col("doc.route"), "line"
    ).withColumnRenamed("item_no", "line_no")
    trains = lines.select(
        "payload_id", "line_no",
        F.coalesce(F.col("line.`@name`"), F.lit("")).alias("line_name"),
        F.posexplode(F.from_json("line.train", _TRAINS)).alias("item_no", "train"),
    )
    return trains.select("payload_id", "line_no", "item_no", "line_name", "train.*")


def train_feed_errors(payloads: DataFrame) -> DataFrame:
    """The documents that were rejected, with their code and text."""
    parsed = payloads.select("payload_id", F.from_json("body", _TRAIN)["ctatt"].alias("doc"))
    return parsed.where(F.coalesce("doc.errCd", F.lit("0")) != "0").select(
        "payload_id", F.col("doc.errCd").alias("code"),
        F.coalesce("doc.errNm", F.lit("unknown")).alias("message"),
    )
