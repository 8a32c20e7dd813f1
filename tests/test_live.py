import json
import random
import time
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from transit_engine.constants import CTA_BUS_TIME_FORMATS, CTA_TRAIN_TIME_FORMATS, CTA_ZONE
from transit_engine.functions.times import parse_local_timestamp
from transit_engine.operators import latest, live
from transit_engine.sources import payloads

NOON = datetime(2024, 1, 1, 12)


def bodies(spark, *documents):
    return spark.createDataFrame(
        [(str(i), json.dumps(d)) for i, d in enumerate(documents)], "payload_id string, body string"
    )


def test_mbta_record(spark):
    vehicle = {
        "id": "v1",
        "attributes": {
            "latitude": 42.1, "longitude": -71.2, "label": "L", "bearing": 90, "speed": None,
            "current_status": "STOPPED_AT", "direction_id": 1,
            "updated_at": "2024-07-01T08:00:00-04:00",
        },
        "relationships": {"route": {"data": {"id": "R"}}, "trip": {"data": None}},
    }
    included = [
        {"type": "stop", "id": "R", "attributes": {"short_name": "no"}},
        {"type": "route", "id": "R", "attributes": {"type": 3, "short_name": "", "long_name": "Old"}},
        {"type": "route", "id": "R", "attributes": {"type": 1, "short_name": "R", "long_name": "Red"}},
    ]
    nowhere = {"id": "v2", "attributes": {"latitude": None, "longitude": 1.0}}
    records = live.normalize_mbta(payloads.scan_mbta_payload(
        bodies(spark, {"data": [vehicle, nowhere], "included": included}, {"data": []})
    ))
    assert rows(
        records, "vehicle_id", "route_id", "route_label", "trip_id", "stop_id", "bearing",
        "direction_id", "route_type", "updated_at", "feed_timestamp",
    ) == [("v1", "R", "R - Red", None, None, 90.0, 1, 1, *[NOON.replace(month=7)] * 2)]


def test_cta_train_list_object_and_rejected_document(spark):
    def train(number, **more):
        return {"rn": number, "lat": "41.9", "lon": "-87.6", **more}

    good = {"ctatt": {"errCd": "0", "route": [
        {"@name": "red line", "train": train("1", isApp="1", trDr="5", destNm="Howard",
                                             prdt="2024-01-01T06:00:00")},
        {"@name": "g", "train": [train("2", trDr="N"), train(" "), train("3", lat="x")]},
        {"@name": "y"},
    ]}}
    bad = {"ctatt": {"errCd": "101", "errNm": "Invalid API key", "route": []}}
    landed = bodies(spark, good, bad)
    records = live.normalize_cta_train(payloads.scan_cta_train_payload(landed))
    assert rows(records, "vehicle_id", "route_id", "route_label", "current_status",
                "direction_id", "updated_at") == [
        ("train-1", "red line", "Red Line Line - Howard", "INCOMING_AT", 5, NOON),
        ("train-2", "g", "G Line", "IN_TRANSIT_TO", None, None),
    ]
    assert rows(payloads.train_feed_errors(landed), "code", "message") == [
        ("101", "Invalid API key")
    ]


def test_cta_bus_blanks_errors_and_labels(spark):
    def bus(number, **more):
        return {"vid": number, "lat": "41.9", "lon": "-87.6", **more}

    landed = bodies(
        spark,
        {"bustime-response": {
            "vehicle": [bus("7 ", rt="9", des="Loop", dly=True, hdg="x", spd=12),
                        bus("8", rt="", des="Park"), bus(" "), bus("10", rt="11")],
            "error": {"rt": "4", "msg": "No data found for parameter"},
            "routes": [{"rt": "9", "rtnm": "Ashland"}, {"rt": "", "rtnm": "?"}],
        }},
        {"bustime-response": {
            "vehicle": [bus("99", rt="11")],
            "error": [{"rt": "11", "msg": "No data found for parameter"}, {"msg": "down"}],
        }},
    )
    responses = payloads.scan_cta_bus_payload(landed)
    inactive, rejected = live.bus_feed_errors(payloads.bus_errors(responses))
    assert rows(inactive, "rt") == [("11",), ("4",)]
    assert rows(rejected, "payload_id", "msg") == [("1", "down")]
    vehicles = payloads.bus_vehicles(responses)
    accepted = live.accepted_vehicles(vehicles, rejected)
    records = live.normalize_cta_bus(accepted, payloads.bus_routes(responses))
    assert rows(records, "vehicle_id", "route_id", "route_label", "current_status", "bearing",
                "speed") == [
        ("bus-10", "11", "11", None, None, None), ("bus-7", "9", "9 - Ashland", "STOPPED_AT", None, 12.0),
        ("bus-8", None, "Park", None, None, None),
    ]
    assert rows(live.active_bus_routes(vehicles, inactive)) == [("9",)]


@pytest.mark.parametrize("text, formats, expected", [
    ("20240310 02:30", CTA_BUS_TIME_FORMATS, datetime(2024, 3, 10, 8, 30)),
    ("20241103 01:30:00", CTA_BUS_TIME_FORMATS, datetime(2024, 11, 3, 6, 30)),
    ("2024-07-01T07:00:00", CTA_TRAIN_TIME_FORMATS, NOON.replace(month=7)),
    ("20240101 06:00:00", CTA_TRAIN_TIME_FORMATS, NOON),
    ("noon", CTA_BUS_TIME_FORMATS, None), ("", CTA_BUS_TIME_FORMATS, None),
])
def test_local_times(spark, text, formats, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_local_timestamp(F.col("t"), formats, CTA_ZONE)).first()[0] == expected


def test_dedupe_keeps_later_tie_and_first_undated(spark):
    early, late = NOON, NOON.replace(hour=13)
    records = spark.createDataFrame(
        [("a", 1, late, None), ("a", 2, None, late), ("a", 3, early, late), ("a", 4, None, None),
         ("b", 1, None, None), ("b", 2, None, None), ("c", 1, None, None), ("c", 2, early, None)],
        "vehicle_id string, seq int, updated_at timestamp, feed_timestamp timestamp",
    ).withColumn("city", F.lit("x"))
    assert rows(live.dedupe_latest(records, ["seq"]), "vehicle_id", "seq") == [
        ("a", 2), ("b", 1), ("c", 2),
    ]


def test_union_of_what_is_there(spark):
    one = spark.createDataFrame([("a", 1)], "vehicle_id string, line_no int")
    two = spark.createDataFrame([("b",)], "vehicle_id string")
    assert rows(live.live_union(one, None, two), "vehicle_id") == [("a",), ("b",)]
    with pytest.raises(ValueError):
        live.live_union(None, None)


def arrivals(spark, count=600, seed=7):
    """Few vehicles, one with half of the rows; times late, tied and missing."""
    rng = random.Random(seed)
    made = []
    for seq in range(count):
        vehicle = "hot" if rng.random() < 0.5 else f"v{rng.randrange(4)}"
        base = datetime(2024, 1, 1, 0, rng.randrange(60), rng.choice([0, 30]))
        updated = None if rng.random() < 0.1 else base
        feed = None if rng.random() < 0.3 else base
        made.append(("b", vehicle, seq, updated, feed, float(rng.randrange(3)), 1.0))
    return made, spark.createDataFrame(
        made, "city string, vehicle_id string, seq long, updated_at timestamp, "
        "feed_timestamp timestamp, latitude double, longitude double",
    )


@pytest.mark.parametrize("block", [1_000_000, 50, 1])
def test_changelog_and_gap_equal_one_by_one_processing(spark, block):
    made, records = arrivals(spark)
    epoch = datetime(1970, 1, 1)
    newest, previous, accepted, gaps = {}, {}, [], []
    for _, vehicle, seq, updated, feed, lat, lon in made:
        time = max(updated or epoch, feed or epoch)
        if time >= newest.get(vehicle, epoch):
            newest[vehicle] = time
            accepted.append((seq,))
        before = previous.get(vehicle)
        gap = 1800
        if before and before[0] and updated and updated > before[0]:
            gap = int(min(max((updated - before[0]).total_seconds() * 1000, 900), 3200))
        gaps.append((seq, bool(before) and before[1] != lat, gap))
        previous[vehicle] = (updated, lat)
    changelog = latest.latest_vehicle_changelog(records, block=block)
    assert rows(changelog, "seq") == sorted(accepted, key=repr)
    gap = latest.vehicle_update_gap(records, block=block)
    assert rows(gap, "seq", "moved", "gap_ms") == sorted(gaps, key=repr)


def test_snapshot_is_the_end_of_the_changelog(spark):
    _, records = arrivals(spark)
    last = latest.latest_vehicle_changelog(records).groupBy("vehicle_id").agg(F.max("seq"))
    assert rows(latest.latest_vehicle_snapshot(records), "vehicle_id", "seq") == rows(last)


def test_listing_expires_filters_and_sorts(spark):
    state = spark.createDataFrame(
        [("b", "v1", "2", "", NOON, 1), ("b", "v2", "1", "Z", NOON, 5), ("b", "v3", "1", None, NOON, 3),
         ("b", "old", "1", "A", NOON.replace(hour=11), 9), ("b", "v4", None, "Q", NOON, 4)],
        "city string, vehicle_id string, route_id string, label string, upserted_at timestamp, seq long",
    )
    now = F.lit(NOON.replace(minute=2, second=59))
    listed = [row["vehicle_id"] for row in latest.list_vehicles(state, now).collect()]
    assert listed == ["v4", "v2", "v3", "v1"]
    only = [row["vehicle_id"] for row in latest.list_vehicles(state, now, route_id="2").collect()]
    assert only == ["v1"]
    assert latest.list_vehicles(state, F.lit(NOON.replace(minute=3))).count() == 0
    health = latest.live_health(state, F.lit(NOON.replace(minute=3)))
    # All were written at one time: the last to arrive counts, not the last by name.
    assert rows(health) == [("b", 0, NOON, "v2")]


def test_later_polls_decide_by_number(spark):
    """"10" comes after "9": a route that was inactive is back, and has its newer name."""
    vehicles = spark.createDataFrame([("10", "r"), ("9", "s")], "payload_id string, rt string")
    inactive = spark.createDataFrame([("9", "r"), ("10", "s")], "payload_id string, rt string")
    assert rows(live.active_bus_routes(vehicles, inactive)) == [("r",)]
    route = "struct<rt:string, rtnm:string>"
    responses = spark.createDataFrame(
        [("9", [("r", "old")]), ("10", [("r", "new")])], f"payload_id string, routes array<{route}>"
    )
    assert rows(payloads.bus_routes(responses)) == [("r", "new")]


def test_cities_are_told_apart_when_records_are_deduped(spark):
    records = spark.createDataFrame(
        [("b", "v", None, "9", 1), ("c", "v", None, "9", 2), ("b", "v", None, "10", 3), ("d", "w", NOON, "9", 4),
         ("d", "w", NOON, "10", 5)],
        "city string, vehicle_id string, updated_at timestamp, payload_id string, n int",
    ).withColumn("feed_timestamp", F.col("updated_at"))
    assert rows(live.dedupe_latest(records, ["payload_id"]), "n") == [(1,), (2,), (5,)]


def mbta_document(n):
    """n vehicles and n routes, each vehicle on a route of its own, the first route listed twice."""
    vehicles = ",".join(
        f'{{"id":"v{k}","attributes":{{"latitude":1,"longitude":2}},'
        f'"relationships":{{"route":{{"data":{{"id":"r{n - 1 - k}"}}}}}}}}' for k in range(n)
    )
    routes = [f'{{"type":"route","id":"r{k}","attributes":{{"short_name":"S{k}"}}}}' for k in range(n)]
    routes += ['{"type":"route","id":"r0","attributes":{"short_name":"last"}}', '{"type":"stop","id":"r1"}']
    return f'{{"data":[{vehicles}],"included":[{",".join(routes)}]}}'


def test_large_documents_look_routes_up_in_linear_time(spark):
    took = []
    for n in (20_000, 20_000, 80_000):  # the first is for warming up
        document = spark.createDataFrame([("1", mbta_document(n))], "payload_id string, body string")
        began = time.perf_counter()
        found = payloads.scan_mbta_payload(document).select(
            F.count("*"), F.count("route"), F.count_if(F.col("route.attributes.short_name") == "last")
        ).first()
        took.append(time.perf_counter() - began)
        assert tuple(found) == (n, n, 1)
    assert took[2] < 8 * max(took[1], 0.5)


def test_lookup_by_join_equals_lookup_in_place(spark):
    bodies = [mbta_document(5), '{"data":[]}', None, "no json", '{"data":[{"id":"x"}],"included":[]}']
    documents = spark.createDataFrame(list(enumerate(bodies)), "payload_id int, body string")
    names = ("payload_id", "item_no", F.col("vehicle.id"), F.col("route.attributes.short_name"))
    in_place, joined = (payloads.scan_mbta_payload(documents, large) for large in (10**9, -1))
    assert rows(in_place, *names) == rows(joined, *names)
    assert in_place.count() == 6
