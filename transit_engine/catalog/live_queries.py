"""Queries of the live side, of files and of sinks."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transit_engine.catalog import feeds
from transit_engine.catalog.queries import _one_city, _IDS, query
from transit_engine.catalog.surrogate import Surrogate
from transit_engine.constants import CTA_BUS_TIME_FORMATS, CTA_ZONE
from transit_engine.functions.times import parse_local_timestamp
from transit_engine.operators import activity, cleaning, latest, live, service_calendar
from transit_engine.plans.batch import build_analytics, clean_all, read_clean
from transit_engine.plans.warehouse import load_datasets, load_single_city
from transit_engine.schemas import ANALYTICS, CLEAN
from transit_engine.session import scratch_path
from transit_engine.sinks import datasets
from transit_engine.sinks.streams import stream_sink_latest as sink_latest
from transit_engine.sinks.streams import stream_sink_raw as sink_raw
from transit_engine.sources import files, payloads, streams
from transit_engine.streaming import latest_vehicle, state_table

_ARRIVAL = ("payload_id", "line_no", "item_no")


def _records(df: DataFrame) -> DataFrame:
    return df.drop(*_ARRIVAL)


# Payloads.


@query
def scan_mbta_payload(s: Surrogate) -> DataFrame:
    scanned = payloads.scan_mbta_payload(feeds.mbta_payloads(s))
    return scanned.select(
        "payload_id", F.col("vehicle.id").alias("vehicle_id"),
        F.col("vehicle.relationships.route.data.id").alias("route_id"),
        F.col("route.attributes.short_name").alias("short_name"),
    )


@query
def scan_cta_bus_payload(s: Surrogate) -> DataFrame:
    """What each document holds, value by value: vehicles, errors and routes."""
    responses = payloads.scan_cta_bus_payload(feeds.cta_bus_payloads(s))
    columns = ["payload_id", "kind", "rt", "name", "dly", "hdg", "lat"]

    def told(kind: str, rows: DataFrame, **named) -> DataFrame:
        given = rows.withColumns({"kind": F.lit(kind), **named})
        missing = F.lit(None).cast("string")
        found = given.select(*[c if c in given.columns else missing.alias(c) for c in columns])
        return found.withColumns({name: F.col(name).try_cast("double") for name in ("hdg", "lat")})

    routes = responses.select("payload_id", F.explode("routes").alias("route")).select("payload_id", "route.*")
    return (
        told("vehicle", payloads.bus_vehicles(responses), name=F.col("vid"))
        .unionByName(told("error", payloads.bus_errors(responses), name=F.col("msg")))
        .unionByName(told("route", routes, name=F.col("rtnm")))
    )


@query
def scan_cta_train_payload(s: Surrogate) -> DataFrame:
    """Every train with its line, value by value."""
    trains = payloads.scan_cta_train_payload(feeds.cta_train_payloads(s))
    return trains.select("payload_id", "line_name", "rn", "destNm", "nextStpId", "isApp", "trDr", "prdt")


@query
def normalize_mbta(s: Surrogate) -> DataFrame:
    return _records(live.normalize_mbta(payloads.scan_mbta_payload(feeds.mbta_payloads(s))))


def _buses(s: Surrogate) -> DataFrame:
    responses = payloads.scan_cta_bus_payload(feeds.cta_bus_payloads(s))
    _, rejected = live.bus_feed_errors(payloads.bus_errors(responses))
    vehicles = live.accepted_vehicles(payloads.bus_vehicles(responses), rejected)
    return live.normalize_cta_bus(vehicles, payloads.bus_routes(responses))


def _trains(s: Surrogate) -> DataFrame:
    return live.normalize_cta_train(payloads.scan_cta_train_payload(feeds.cta_train_payloads(s)))


@query
def normalize_cta_bus(s: Surrogate) -> DataFrame:
    return _records(_buses(s))


@query
def normalize_cta_train(s: Surrogate) -> DataFrame:
    return _records(_trains(s))


@query
def live_union(s: Surrogate) -> DataFrame:
    return _records(live.live_union(_buses(s), None, _trains(s)))


@query
def parse_local_timestamp_query(s: Surrogate) -> DataFrame:
    reading = feeds.local_time_text(F.col("event_id"))
    return s.live_events.select(
        "event_id", parse_local_timestamp(reading, CTA_BUS_TIME_FORMATS, CTA_ZONE).alias("instant")
    )


@query
def bus_feed_errors(s: Surrogate) -> DataFrame:
    errors = payloads.bus_errors(payloads.scan_cta_bus_payload(feeds.cta_bus_payloads(s)))
    inactive, rejected = live.bus_feed_errors(errors)
    return inactive.select("payload_id", F.lit("inactive").alias("kind"), "rt").unionByName(
        rejected.select("payload_id", F.lit("rejected").alias("kind"), "rt")
    )


@query
def active_bus_routes(s: Surrogate) -> DataFrame:
    responses = payloads.scan_cta_bus_payload(feeds.cta_bus_payloads(s))
    inactive, _ = live.bus_feed_errors(payloads.bus_errors(responses))
    return live.active_bus_routes(payloads.bus_vehicles(responses), inactive)


@query
def dedupe_latest(s: Surrogate) -> DataFrame:
    return live.dedupe_latest(s.live, ["seq"])


# Latest state over a bounded table.


@query
def latest_vehicle_changelog(s: Surrogate) -> DataFrame:
    return latest.latest_vehicle_changelog(s.live)


@query
def latest_vehicle_snapshot(s: Surrogate) -> DataFrame:
    return latest.latest_vehicle_snapshot(s.live)


@query
def vehicle_snapshot_merge(s: Surrogate) -> DataFrame:
    return latest.vehicle_snapshot_merge(s.live)


def _state(s: Surrogate) -> DataFrame:
    written = F.coalesce("updated_at", "feed_timestamp", F.timestamp_seconds(F.lit(0)))
    return latest.latest_vehicle_snapshot(s.live).withColumn("upserted_at", written)


_TTL = 86_400


@query
def list_vehicles(s: Surrogate) -> DataFrame:
    state = _state(s)
    now = state.select(F.max("upserted_at")).scalar()
    return latest.list_vehicles(state, now, ttl_seconds=_TTL).select(
        "city", "vehicle_id", "route_id", "label", "upserted_at"
    )


@query
def live_health(s: Surrogate) -> DataFrame:
    state = _state(s)
    now = state.select(F.max("upserted_at")).scalar()
    return latest.live_health(state, now, ttl_seconds=_TTL)


@query
def vehicle_update_gap(s: Surrogate) -> DataFrame:
    return latest.vehicle_update_gap(s.live).select("city", "vehicle_id", "seq", "moved", "gap_ms")


# Streams. Each runs over all live records and gives back what it wrote.


def _run_to_files(s: Surrogate, stream: DataFrame, name: str) -> DataFrame:
    out = scratch_path(s.spark, name)
    started = (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(s.spark, f"{name}-checkpoint"))
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return s.spark.read.schema(stream.schema).parquet(out)


def _written_messages(s: Surrogate, start, stream: DataFrame, name: str) -> DataFrame:
    out = scratch_path(s.spark, name)
    start(
        stream, scratch_path(s.spark, f"{name}-checkpoint"), path=out, once=True
    ).awaitTermination()
    return streams.valid_records(s.spark.read.schema(streams.MESSAGE).parquet(out))


def _raw_messages(s: Surrogate) -> DataFrame:
    landed = feeds.land_messages(s.live, scratch_path(s.spark, "landed"))
    return streams.stream_raw(s.spark, path=landed, files_per_trigger=None)


def _accepted_records(s: Surrogate) -> DataFrame:
    accepted = latest.latest_vehicle_changelog(s.live).drop("ts_ms")
    landed = feeds.land_messages(accepted, scratch_path(s.spark, "landed"))
    return streams.stream_latest(s.spark, path=landed, files_per_trigger=None)


@query
def stream_raw(s: Surrogate) -> DataFrame:
    return _run_to_files(s, streams.valid_records(_raw_messages(s)), "stream_raw")


@query
def stream_latest(s: Surrogate) -> DataFrame:
    return _run_to_files(s, _accepted_records(s), "stream_latest")


@query
def stream_sink_raw(s: Surrogate) -> DataFrame:
    records = streams.valid_records(_raw_messages(s))
    return _written_messages(s, sink_raw, records, "sink_raw")


@query
def stream_sink_latest(s: Surrogate) -> DataFrame:
    """Accepted by micro-batch, which no vehicle's number of messages matters to, and sent on."""
    out, state, checkpoint = (
        scratch_path(s.spark, f"sink-{name}") for name in ("accepted", "newest", "newest-checkpoint")
    )
    latest_vehicle.keep_latest(_raw_messages(s), out, state, checkpoint, once=True).awaitTermination()
    accepted = s.spark.readStream.schema(latest_vehicle.ACCEPTED).parquet(f"{out}/batch=*")
    return _written_messages(s, sink_latest, accepted, "sink_latest")


@query
def keyed_latest_stream(s: Surrogate) -> DataFrame:
    """Keyed state over times only; the messages are put back by arrival and vehicle."""
    narrow = latest_vehicle.latest_vehicle_stream(_raw_messages(s), payload=False)
    accepted = _run_to_files(s, narrow, "keyed_latest")
    landed = feeds.land_messages(s.live, scratch_path(s.spark, "landed"))
    messages = s.spark.read.schema(streams.MESSAGE).parquet(landed)
    return latest_vehicle.with_payload(accepted, messages).select(
        "city", "vehicle_id", "seq", "ts_ms", F.get_json_object("value", "$.route_id").alias("route_id")
    )


@query
def latest_vehicle_stream(s: Surrogate) -> DataFrame:
    """Three runs of one query, each over a third of the arrivals: state lives between them."""
    landed, out, state, checkpoint = (
        scratch_path(s.spark, f"latest-{name}") for name in ("landed", "out", "state", "checkpoint")
    )
    last = s.live.agg(F.max("seq")).first()[0] or 0
    for third in range(3):
        part = s.live.where(F.least(F.floor(F.col("seq") * 3 / (last + 1)), F.lit(2)) == third)
        feeds.land_messages(part, landed)
        messages = streams.stream_raw(s.spark, path=landed, files_per_trigger=None)
        latest_vehicle.keep_latest(messages, out, state, checkpoint, once=True).awaitTermination()
    return latest_vehicle.accepted_messages(s.spark, out).drop("value")


@query
def live_state_upsert(s: Surrogate) -> DataFrame:
    folder = scratch_path(s.spark, "state")
    state_table.maintain_state(
        _accepted_records(s), folder, scratch_path(s.spark, "state-checkpoint"), once=True,
        ttl_seconds=None,
    ).awaitTermination()
    return state_table.read_state(s.spark, folder).drop("upserted_at")


_CLOCKS = [datetime(2024, 6, 1, 12, 0, second, tzinfo=timezone.utc) for second in (0, 20, 40)]
_LIFE = 30


def _kept_by_thirds(s: Surrogate) -> str:
    """The state after three batches, each a third of the arrivals, 20 seconds apart; records live
    for 30 seconds. Slots are few, so that all are compacted once and again."""
    folder, landed = scratch_path(s.spark, "state"), scratch_path(s.spark, "landed")
    accepted = latest.latest_vehicle_changelog(s.live).drop("ts_ms")
    last = accepted.agg(F.max("seq")).first()[0] or 0
    third = F.least(F.floor(F.col("seq") * 3 / (last + 1)), F.lit(2))
    for number, clock in enumerate(_CLOCKS):
        feeds.land_messages(accepted.where(third == number), landed)
        records = streams.stream_latest(s.spark, path=landed, files_per_trigger=None)
        state_table.maintain_state(
            records, folder, f"{folder}-checkpoint", once=True, ttl_seconds=_LIFE,
            clock=lambda clock=clock: clock, slots=2,
        ).awaitTermination()
    return folder


@query
def live_state_expiry(s: Surrogate) -> DataFrame:
    """Vehicles whose last record was written within the life time, by folders that hold any."""
    folder = _kept_by_thirds(s)
    return state_table.read_live(s.spark, folder, _CLOCKS[-1], _LIFE)


@query
def live_health_after_expiry(s: Surrogate) -> DataFrame:
    """Last writes outlive the records: asked for when all of them are over."""
    folder = _kept_by_thirds(s)
    told = []
    for name, later in (("at once", 0), ("when all are over", 60)):
        now = _CLOCKS[-1] + timedelta(seconds=later)
        state = state_table.read_live(s.spark, folder, now, _LIFE)
        writes = state_table.read_last_writes(s.spark, folder)
        told.append(latest.live_health(state, F.lit(now), _LIFE, writes).withColumn("asked", F.lit(name)))
    return told[0].unionByName(told[1])


# Files and datasets.

# An integer column of each dataset whose sum stands for its content.
MEASURES = {
    "stops": "location_type", "routes": "route_type", "trips": "direction_id",
    "stop_times": "stop_sequence", "shapes": "shape_pt_sequence", "roads": "osm_id",
    "pois": "osm_id", "stop_activity": "trip_count", "stop_activity_enriched": "trip_count",
    "route_activity": "distinct_trip_count", "stop_activity_by_route": "trip_count",
    "route_shapes": "shape_pt_sequence", "stop_poi_access": "poi_count_within_400m",
    "busiest_stops_with_poi_context": "poi_count_within_400m",
    "route_poi_access": "total_poi_access", "transit_road_coverage": "road_segments_near_transit",
}


def _measured(tables: dict[str, DataFrame], upper: bool = False) -> DataFrame:
    """city, dataset, row_count, measure of every table."""
    told = None
    for name, table in tables.items():
        city, measure = ("CITY", MEASURES[name].upper()) if upper else ("city", MEASURES[name])
        assert {city, measure} <= set(table.columns)
        one = table.groupBy(F.col(city).alias("city")).agg(
            F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col(measure).cast("long")).alias("measure"),
        )
        told = one if told is None else told.unionByName(one)
    return told


def _raw_folders(s: Surrogate, **tables: DataFrame) -> dict[str, str]:
    """Raw text files per city, as feeds deliver them."""
    root = scratch_path(s.spark, "raw")
    cities = ["boston", "chicago"]
    for name, df in tables.items():
        for city in cities:
            (
                df.where(F.col("city") == city).drop("city").write.option("header", True)
                .option("ignoreLeadingWhiteSpace", False)
                .option("ignoreTrailingWhiteSpace", False)
                .csv(f"{root}/{city}/{name.replace('__', '.')}")
            )
    return {city: f"{root}/{city}" for city in cities}


def _as_lines(tables: dict[str, DataFrame]) -> DataFrame:
    """Every row of the tables as city, table and its fields in one text, ``~`` for a missing one."""
    told = None
    for name, table in tables.items():
        fields = [F.coalesce(F.col(n), F.lit("~")) for n in table.columns if n != "city"]
        one = table.select("city", F.lit(name).alias("dataset"), F.concat_ws("|", *fields).alias("line"))
        told = one if told is None else told.unionByName(one)
    return told


@query
def scan_gtfs(s: Surrogate) -> DataFrame:
    """All five schedule tables of both cities, value by value."""
    raw = {name: getattr(s, f"raw_{name}") for name in files.GTFS_TABLES}
    folders = _raw_folders(s, **{f"{name}__txt": table for name, table in raw.items()})
    scanned = {name: files.scan_gtfs(s.spark, folders, name) for name in raw}
    return _as_lines({name: table.select(*raw[name].columns) for name, table in scanned.items()})


@query
def scan_gtfs_stop_times(s: Surrogate) -> DataFrame:
    folders = _raw_folders(s, stop_times__txt=s.raw_stop_times)
    return files.scan_gtfs(s.spark, folders, "stop_times")


@query
def scan_calendar(s: Surrogate) -> DataFrame:
    folders = _raw_folders(s, calendar__txt=s.calendar, calendar_dates__txt=s.calendar_dates)
    return service_calendar.active_service_dates(*files.scan_calendar(s.spark, folders))


@query
def scan_osm(s: Surrogate) -> DataFrame:
    """Roads and places of both cities, value by value."""
    raw = {"roads": s.raw_roads, "pois": s.raw_pois}
    folders = _raw_folders(s, **{f"{name}__csv": table for name, table in raw.items()})
    scanned = {name: files.scan_osm(s.spark, folders, name) for name in raw}
    return _as_lines({name: table.select(*raw[name].columns) for name, table in scanned.items()})


@query
def scan_osm_counts(s: Surrogate) -> DataFrame:
    folders = _raw_folders(s, roads__csv=s.raw_roads)
    return files.scan_osm(s.spark, folders, "roads").groupBy("city").agg(
        F.count(F.lit(1)).alias("segments"), F.count_distinct("osm_id").alias("ids")
    )


# A whole number of each clean table, besides those in MEASURES that are ids.
_CLEAN_MEASURES = MEASURES | {"roads": "length_m", "pois": "lon"}


@query
def clean_without_city(s: Surrogate) -> DataFrame:
    """All seven tables cleaned as a single city's, without a city column in what is read.

    The two cities' ids are told apart by the city in front of them.
    """
    told = None
    for name in CLEAN:
        raw = getattr(s, f"raw_{name}")
        ids = {n: F.concat("city", F.lit("/"), n) for n in (*_IDS, "osm_id") if n in raw.columns}
        clean = getattr(cleaning, f"clean_{name}")(raw.withColumns(ids).drop("city"), city="both")
        one = clean.groupBy("city").agg(
            F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count"),
            F.sum(F.floor(_CLEAN_MEASURES[name])).alias("measure"),
        )
        told = one if told is None else told.unionByName(one)
    return told


@query
def scan_clean(s: Surrogate) -> DataFrame:
    """All seven clean tables, written and read back."""
    root = scratch_path(s.spark, "clean")
    for table in CLEAN:
        datasets.write_dataset(getattr(s, table), root, table)
    return _measured({table: files.scan_clean(s.spark, root, table) for table in CLEAN})


@query
def write_dataset(s: Surrogate) -> DataFrame:
    root = scratch_path(s.spark, "analytics")
    datasets.write_dataset(s.stop_activity, root, "stop_activity")
    return files.read_dataset(s.spark, root, "stop_activity", ANALYTICS["stop_activity"])


@query
def warehouse_union(s: Surrogate) -> DataFrame:
    """All sixteen datasets, each stacked from one part per city."""
    stacked = {
        name: datasets.warehouse_union([
            getattr(s, name).where(F.col("city") == city) for city in ("boston", "chicago")
        ])
        for name in MEASURES
    }
    return _measured(stacked, upper=True)


def _single_city_tables(s: Surrogate) -> dict[str, DataFrame]:
    """The ten city-less datasets over both cities' rows."""
    stops, routes, trips, stop_times, shapes = (
        _one_city(getattr(s, name), *_IDS) for name in ("stops", "routes", "trips", "stop_times", "shapes")
    )
    used = _one_city(s.trips.where(F.col("shape_id").isNotNull()), *_IDS)
    counts = activity.stop_activity_raw(stop_times)
    return {
        "stops": stops, "routes": routes, "trips": trips, "stop_times": stop_times, "shapes": shapes,
        "stop_activity": counts,
        "stop_activity_enriched": activity.single_city_stop_activity_enriched(stops, counts),
        "route_activity": activity.single_city_route_activity(stop_times, trips, routes),
        "stop_activity_by_route": activity.single_city_stop_activity_by_route(stop_times, trips, routes, stops),
        "route_shapes": activity.single_city_route_shapes(used, routes, shapes),
    }


@query
def legacy_load(s: Surrogate) -> DataFrame:
    """The ten city-less datasets, written, loaded as warehouse tables and read from there."""
    root = scratch_path(s.spark, "single-city")
    for name, table in _single_city_tables(s).items():
        table.write.parquet(f"{root}/{name}")
    tables = load_single_city(s.spark, root, root, f"run_{uuid.uuid4().hex[:12]}_")
    told = None
    for dataset, name in tables.items():
        loaded = s.spark.table(name)
        one = loaded.agg(
            F.lit(dataset).alias("dataset"), F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col(MEASURES[dataset].upper()).cast("long")).alias("measure"),
            F.count_distinct(loaded.columns[0]).alias("ids"),
        )
        told = one if told is None else told.unionByName(one)
    out = scratch_path(s.spark, "loaded")
    told.write.parquet(out)
    for name in tables.values():
        s.spark.sql(f"DROP TABLE {name}")
    return s.spark.read.schema(told.schema).parquet(out)


@query
def legacy_load_stops(s: Surrogate) -> DataFrame:
    """One of them, value by value."""
    counts = activity.stop_activity_raw(_one_city(s.stop_times, *_IDS))
    enriched = activity.single_city_stop_activity_enriched(_one_city(s.stops, *_IDS), counts)
    return datasets.warehouse_union([enriched])


@query
def dataset_row_counts(s: Surrogate) -> DataFrame:
    return datasets.dataset_row_counts({name: getattr(s, name) for name in MEASURES})


@query
def raw_to_warehouse(s: Surrogate) -> DataFrame:
    """The whole run: raw files of all tables and both cities are cleaned, analysed and loaded.

    Trips and stop times write their ids differently in the test tables; here they agree.
    """
    stop_times = s.raw_stop_times.withColumn("trip_id", F.regexp_replace("trip_id", r"^( *)0+(?=[0-9])", "$1"))
    gtfs = _raw_folders(
        s, stops__txt=s.raw_stops, routes__txt=s.raw_routes, trips__txt=s.raw_trips,
        stop_times__txt=stop_times, shapes__txt=s.raw_shapes, calendar__txt=s.calendar,
        calendar_dates__txt=s.calendar_dates,
    )
    osm = _raw_folders(s, roads__csv=s.raw_roads, pois__csv=s.raw_pois)
    clean_root, root = scratch_path(s.spark, "clean"), scratch_path(s.spark, "analytics")
    cities = list(gtfs)
    clean_all(s.spark, gtfs, osm, clean_root)
    build_analytics(s.spark, read_clean(s.spark, clean_root), root, cities)
    prefix = f"run_{uuid.uuid4().hex[:12]}_"
    tables = load_datasets(s.spark, clean_root, root, cities, prefix)
    told = _measured({dataset: s.spark.table(name) for dataset, name in tables.items()}, upper=True)
    out = scratch_path(s.spark, "loaded")
    told.write.parquet(out)
    for name in tables.values():
        s.spark.sql(f"DROP TABLE {name}")
    return s.spark.read.schema(told.schema).parquet(out)


@query
def build_analytics_query(s: Surrogate) -> DataFrame:
    """The whole batch build; the row count of each table it wrote."""
    counts = build_analytics(s.spark, s.tables, scratch_path(s.spark, "analytics"))
    return s.spark.createDataFrame(list(counts.items()), "dataset string, row_count long")
