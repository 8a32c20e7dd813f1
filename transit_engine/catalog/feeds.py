"""Agency responses and message files made from the live test records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.catalog.surrogate import Surrogate, c, padded, text
from transit_engine.constants import CTA_INACTIVE_ROUTE_MESSAGE
from transit_engine.sources.streams import to_messages

# A response holds the events of one hundred consecutive numbers.
_PER_PAYLOAD = 100


def _events(s: Surrogate) -> DataFrame:
    return s.live_events.withColumn("payload_id", text(F.floor(c("event_id") / _PER_PAYLOAD)))


def _ordered(item: Column) -> Column:
    """The group's items by event number; a group is one response of at most 100."""
    rows = F.array_sort(F.collect_list(F.struct(c("event_id"), item.alias("item"))))
    return F.transform(rows, lambda row: row["item"])


def _route(user: Column) -> Column:
    return F.when(user % 17 != 0, text(user % 40))


def mbta_payloads(s: Surrogate) -> DataFrame:
    user, key = c("user_id"), c("event_id")
    number = user % 40

    def related(value: Column) -> Column:
        return F.struct(F.when(value.isNotNull(), F.struct(value.alias("id"))).alias("data"))

    attributes = F.struct(
        F.when(key % 23 != 0, c("latitude")).alias("latitude"), "longitude", "label", "bearing",
        F.when(key % 5 != 0, c("speed")).alias("speed"), "current_status", "direction_id",
        F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("updated_at"),
    )
    vehicle = F.struct(
        c("vehicle_id").alias("id"), attributes.alias("attributes"),
        F.struct(
            related(c("route_id")).alias("route"), related(c("trip_id")).alias("trip"),
            related(F.lit(None).cast("string")).alias("stop"),
        ).alias("relationships"),
    )
    route = F.when(c("route_id").isNotNull(), F.struct(
        F.lit("route").alias("type"), c("route_id").alias("id"),
        F.struct(
            (user % 5).alias("type"), F.concat(F.lit("S"), text(number)).alias("short_name"),
            F.when(number % 3 != 0, F.concat(F.lit("Line "), text(number))).alias("long_name"),
        ).alias("attributes"),
    ))
    return _events(s).groupBy("payload_id").agg(
        F.to_json(F.struct(
            _ordered(vehicle).alias("data"), F.collect_set(route).alias("included")
        )).alias("body")
    )


def local_time_text(key: Column) -> Column:
    """The event time as a local reading, with or without seconds, sometimes missing."""
    return F.when(key % 19 != 0, F.when(
        key % 2 == 0, F.date_format("ts", "yyyyMMdd HH:mm:ss")
    ).otherwise(F.date_format("ts", "yyyyMMdd HH:mm")))


def cta_bus_payloads(s: Surrogate) -> DataFrame:
    user, key = c("user_id"), c("event_id")
    vehicle = F.struct(
        F.when(key % 29 == 0, " ").otherwise(padded(text(user), key % 7 == 0)).alias("vid"),
        F.when(key % 23 == 0, "n/a").otherwise(text("latitude")).alias("lat"),
        text("longitude").alias("lon"), _route(user).alias("rt"),
        F.concat(F.lit("To "), c("trip_id")).alias("des"),
        F.when(c("event_type") == "click", F.when(key % 2 == 0, "true").otherwise("True"))
        .otherwise("false").alias("dly"),
        local_time_text(key).alias("tmstmp"),
        F.when(key % 5 == 0, "n/a").otherwise(text("bearing")).alias("hdg"),
        F.lit("fast").alias("spd"), c("trip_id").alias("tatripid"),
    )
    route = F.when(_route(user).isNotNull() & (user % 40 % 4 != 0), F.struct(
        _route(user).alias("rt"), F.concat(F.lit("Line "), _route(user)).alias("rtnm")
    ))
    error = F.when(key % 701 == 5, F.to_json(F.struct(F.lit("Internal error").alias("msg")))).when(
        key % 97 == 0,
        F.to_json(F.struct(
            text(user % 40).alias("rt"), F.lit(CTA_INACTIVE_ROUTE_MESSAGE).alias("msg")
        )),
    )
    parts = _events(s).groupBy("payload_id").agg(
        F.to_json(_ordered(vehicle)).alias("vehicles"), F.collect_list(error).alias("errors"),
        F.to_json(F.collect_set(route)).alias("routes"),
    )
    # One error alone is an object, several are a list.
    errors = F.when(F.size("errors") == 1, c("errors")[0]).otherwise(
        F.concat(F.lit("["), F.array_join("errors", ","), F.lit("]"))
    )
    body = F.concat(
        F.lit('{"bustime-response":{"vehicle":'), c("vehicles"), F.lit(',"error":'), errors,
        F.lit(',"routes":'), c("routes"), F.lit("}}"),
    )
    return parts.select("payload_id", body.alias("body"))


def cta_train_payloads(s: Surrogate) -> DataFrame:
    user, key = c("user_id"), c("event_id")
    line = F.when(key % 3 == 0, "red").when(key % 3 == 1, "g").otherwise("pink")
    train = F.struct(
        F.when(key % 29 == 0, "").otherwise(padded(text(user), key % 7 == 0)).alias("rn"),
        F.when(key % 23 == 0, "n/a").otherwise(text("latitude")).alias("lat"),
        text("longitude").alias("lon"),
        F.when(key % 5 != 0, F.concat(F.lit("To "), c("trip_id"))).alias("destNm"),
        c("stop_id").alias("nextStpId"), F.when(key % 3 == 0, "1").otherwise("0").alias("isApp"),
        F.when(key % 7 == 0, "x").otherwise(text(user % 2)).alias("trDr"),
        F.when(key % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyyMMdd HH:mm:ss")).alias("prdt"),
        text("bearing").alias("heading"),
    )
    lines = _events(s).groupBy("payload_id", line.alias("line")).agg(
        _ordered(train).alias("trains")
    )
    # A line with one train carries it as an object instead of a list.
    trains = F.when(F.size("trains") == 1, F.to_json(c("trains")[0])).otherwise(
        F.to_json("trains")
    )
    block = F.concat(
        F.lit('{"@name":"'), c("line"), F.lit('","train":'), trains, F.lit("}")
    )
    failed = c("payload_id").cast("long") % 13 == 4
    ok = F.concat(
        F.lit('{"ctatt":{"errCd":"0","route":['), F.array_join("blocks", ","), F.lit("]}}")
    )
    return lines.groupBy("payload_id").agg(F.collect_list(block).alias("blocks")).select(
        "payload_id",
        F.when(failed, '{"ctatt":{"errCd":"101","errNm":"bad key","route":[]}}').otherwise(ok)
        .alias("body"),
    )


def land_messages(records: DataFrame, landed: str) -> str:
    """Message files of some records, as many as there are tasks; ``seq`` has the arrival order."""
    to_messages(records).select("seq", "value").write.mode("append").parquet(landed)
    return landed
