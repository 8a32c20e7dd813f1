"""Transit tables computed from the general test tables, by arithmetic on their keys.

The test data has no transit tables. Each one is derived here from a whole test table, so its
size follows the data; ``catalog.oracle`` states the same definitions in SQL. Values are spread
so that every rule of the operators is met: stops without a row, unknown routes and services,
periods that end before they start, dates added and removed twice, unknown categories, repeated
keys, late, tied and undated live records.
"""

from __future__ import annotations

from dataclasses import fields
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_engine.constants import POI_GROUPS, ROAD_CLASSES
from transit_engine.operators import access, activity, service_calendar
from transit_engine.operators.cleaning import poi_group
from transit_engine.operators.ranked import freed, written
from transit_engine.plans.batch import TransitTables, build_analytics
from transit_engine.plans.snapshot import AnalyticsTables
from transit_engine.schemas import ANALYTICS
from transit_engine.session import scratch_path
from transit_engine.sources.files import read_dataset

# Test places: city, south-west corner as latitude and longitude in 1/10000 degree.
_CORNERS = [("boston", 423000, -711500), ("chicago", 418000, -877500)]
_CATEGORIES = [*POI_GROUPS, "bench", "fuel"]
_HIGHWAYS = [*ROAD_CLASSES, "footway", "path"]
_STATUS = {"view": "IN_TRANSIT_TO", "click": "STOPPED_AT", "purchase": "INCOMING_AT"}


def c(name: str) -> Column:
    return F.col(name)


def text(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def city_of(key: str) -> Column:
    return F.when(c(key) % 2 == 0, "boston").otherwise("chicago")


def pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number + 1).cast("int"))


def ten_thousandths(corner: str, key: Column, factor: int, size: int) -> Column:
    """A coordinate as a whole number of 1/10000 degrees."""
    return c(corner) + (key * factor) % size


def degrees(units: Column) -> Column:
    return units / F.lit(10000.0)


def degrees_text(units: Column) -> Column:
    whole = F.abs(units)
    digits = F.concat(
        text(F.floor(whole / 10000)), F.lit("."), F.lpad(text(whole % 10000), 4, "0")
    )
    return F.when(units < 0, F.concat(F.lit("-"), digits)).otherwise(digits)


def padded(column: Column, when: Column) -> Column:
    return F.when(when, F.concat(F.lit("  "), column, F.lit(" "))).otherwise(column)


# The columns used of each test table; with a schema given, no job reads file footers first.
_SCHEMAS = {
    "part": "p_partkey long, p_name string, p_size int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double",
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_returnflag string, l_linestatus string"
    ),
    "events": (
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    ),
}


# Folders of analytics tables that this process has built, by session, input and state of its files.
_BUILT: dict[tuple, str] = {}


class Surrogate:
    """Lazily built tables over one folder of test data."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[table]).parquet(f"{self.sf_dir}/{table}.parquet")

    def state(self) -> tuple:
        """Number and digest of the input files' names, lengths and modification times."""
        paths = [f"{self.sf_dir}/{table}.parquet" for table in _SCHEMAS]
        files = self.spark.read.format("binaryFile").load(paths)
        told = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        return tuple(files.agg(F.count("*"), F.sum(told)).first())

    def in_both_cities(self, table: str) -> DataFrame:
        corners = F.array(*[
            F.struct(F.lit(n).alias("city"), F.lit(a).alias("lat0"), F.lit(o).alias("lon0"))
            for n, a, o in _CORNERS
        ])
        return self.raw(table).select("*", F.inline(corners))

    # Clean tables.

    @cached_property
    def stops(self) -> DataFrame:
        key = c("p_partkey")
        return self.in_both_cities("part").select(
            "city", text(key).alias("stop_id"), c("p_name").alias("stop_name"),
            degrees(ten_thousandths("lat0", key, 7919, 2000)).alias("stop_lat"),
            degrees(ten_thousandths("lon0", key, 104729, 1999)).alias("stop_lon"),
            (c("p_size") % 2).cast("int").alias("location_type"),
            F.when(key % 5 == 0, text(key % 7)).alias("parent_station"),
        )

    @cached_property
    def routes(self) -> DataFrame:
        key = c("c_custkey")
        kinds = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
        kind = F.array_position(F.array(*[F.lit(k) for k in kinds]), c("c_mktsegment")) - 1
        return self.in_both_cities("customer").select(
            "city", text(key).alias("route_id"),
            F.when(key % 9 != 0, F.concat(F.lit("R"), text(key))).alias("route_short_name"),
            F.when(key % 8 != 0, c("c_name")).alias("route_long_name"),
            kind.cast("int").alias("route_type"),
        )

    @cached_property
    def trips(self) -> DataFrame:
        key, route = c("o_orderkey"), text("o_custkey")
        return self.raw("orders").select(
            city_of("o_orderkey").alias("city"),
            F.when(key % 41 == 0, F.concat(F.lit("unlisted-"), route))
            .otherwise(route).alias("route_id"),
            F.when(key % 31 == 0, "none").when(key % 29 != 0, route).alias("service_id"),
            text(key).alias("trip_id"),
            (c("o_custkey") % 2).cast("int").alias("direction_id"),
            F.when(key % 10 != 0, F.concat(route, F.lit("-"), text(key % 3))).alias("shape_id"),
        )

    @cached_property
    def stop_times(self) -> DataFrame:
        stop = text("l_partkey")
        clock = F.concat(
            F.lpad(text(4 + c("l_linenumber") * 3), 2, "0"), F.lit(":"),
            F.lpad(text(c("l_partkey") % 60), 2, "0"), F.lit(":00"),
        )
        return self.raw("lineitem").select(
            city_of("l_orderkey").alias("city"), text("l_orderkey").alias("trip_id"),
            clock.alias("arrival_time"), clock.alias("departure_time"),
            F.when(c("l_suppkey") % 50 == 0, F.concat(F.lit("closed-"), stop))
            .otherwise(stop).alias("stop_id"),
            c("l_linenumber").cast("int").alias("stop_sequence"),
        )

    @cached_property
    def shapes(self) -> DataFrame:
        key = c("o_orderkey")
        return self.in_both_cities("orders").select(
            "city", F.concat(text("o_custkey"), F.lit("-"), text(key % 3)).alias("shape_id"),
            degrees(ten_thousandths("lat0", key, 7919, 2000)).alias("shape_pt_lat"),
            degrees(ten_thousandths("lon0", key, 104729, 1999)).alias("shape_pt_lon"),
            (key % 2_000_000_000).cast("int").alias("shape_pt_sequence"),
        )

    @cached_property
    def pois(self) -> DataFrame:
        category = pick(_CATEGORIES, c("c_custkey") % len(_CATEGORIES))
        key = c("c_custkey")
        return (
            self.in_both_cities("customer")
            .select(
                "city", text(key).alias("osm_id"), c("c_name").alias("name"),
                category.alias("poi_category"),
                degrees(ten_thousandths("lat0", key, 6151, 2000)).alias("lat"),
                degrees(ten_thousandths("lon0", key, 3571, 1999)).alias("lon"),
            )
            .where(c("poi_category").isin(list(POI_GROUPS)))
            .withColumn("poi_group", poi_group(c("poi_category")))
        )

    @cached_property
    def roads(self) -> DataFrame:
        """One segment per order; a few of the classes are not kept."""
        key = c("o_orderkey")
        return (
            self.in_both_cities("orders")
            .select(
                "city", text(key).alias("osm_id"),
                pick(_HIGHWAYS, c("o_custkey") % len(_HIGHWAYS)).alias("highway"),
                degrees(ten_thousandths("lat0", key, 6151, 2000)).alias("mid_lat"),
                degrees(ten_thousandths("lon0", key, 3571, 1999)).alias("mid_lon"),
                F.when(key % 13 != 0, c("o_totalprice") / 1000).alias("length_m"),
            )
            .where(c("highway").isin(ROAD_CLASSES))
        )

    @cached_property
    def calendar(self) -> DataFrame:
        """Raw text. Flags are the bits of the key; some periods end before they start."""
        key = c("c_custkey")
        start = F.date_add(F.lit("2024-01-01").cast("date"), c("c_nationkey").cast("int"))
        end = F.date_add(start, (key % 28 - 2).cast("int"))
        days = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
        return self.in_both_cities("customer").select(
            "city", text(key).alias("service_id"),
            *[text(F.floor(key / (1 << i)) % 2).alias(day) for i, day in enumerate(days)],
            F.date_format(start, "yyyyMMdd").alias("start_date"),
            F.date_format(end, "yyyyMMdd").alias("end_date"),
        )

    @cached_property
    def calendar_dates(self) -> DataFrame:
        """Raw text. Three exceptions per service; some hit one date with both types."""
        rows = self.in_both_cities("customer").select(
            "*", F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("k")
        )
        shift = (c("c_custkey") * (c("k") + 1)) % 45
        date = F.date_add(F.lit("2024-01-01").cast("date"), shift.cast("int"))
        return rows.select(
            "city", text("c_custkey").alias("service_id"),
            F.date_format(date, "yyyyMMdd").alias("date"),
            text(1 + (c("c_custkey") + c("k")) % 2).alias("exception_type"),
        )

    @cached_property
    def live(self) -> DataFrame:
        """Live records with their arrival number ``seq``; some arrive about 50 records late."""
        return self.live_events.drop("event_id", "user_id", "event_type", "ts")

    @cached_property
    def live_events(self) -> DataFrame:
        key, user = c("event_id"), c("user_id")
        ts = c("ts").cast("timestamp")
        lat0 = F.when(user % 2 == 0, 423000).otherwise(418000)
        lon0 = F.when(user % 2 == 0, -711500).otherwise(-877500)
        return self.raw("events").select(
            "event_id", "user_id", "event_type", ts.alias("ts"),
            city_of("user_id").alias("city"),
            F.concat(F.lit("veh-"), text(user)).alias("vehicle_id"),
            F.when(user % 17 != 0, text(user % 40)).alias("route_id"),
            F.concat(F.lit("Route "), text(user % 40)).alias("route_label"),
            text(key % 500).alias("trip_id"), text(key % 300).alias("stop_id"),
            F.when(user % 7 == 0, "").otherwise(F.concat(F.lit("L"), text(user))).alias("label"),
            degrees(lat0 + F.floor(key / 3) * 37 % 2000).alias("latitude"),
            degrees(lon0 + F.floor(key / 3) * 53 % 1999).alias("longitude"),
            (key % 360).cast("double").alias("bearing"), c("value").alias("speed"),
            F.coalesce(*[F.when(c("event_type") == e, s) for e, s in _STATUS.items()]).alias(
                "current_status"
            ),
            F.lit(None).cast("string").alias("occupancy_status"),
            (user % 2).cast("int").alias("direction_id"),
            (user % 5).cast("int").alias("route_type"),
            F.when(key % 11 != 0, ts).alias("updated_at"),
            F.when(key % 13 != 0, ts).alias("feed_timestamp"),
            F.lit("test").alias("source"),
            (key * 2 + F.when(key % 17 == 0, 101).otherwise(0)).alias("seq"),
        )

    # Raw text tables with blemishes.

    def _twice(self, df: DataFrame) -> DataFrame:
        return df.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))

    @cached_property
    def raw_stops(self) -> DataFrame:
        key = c("p_partkey")
        name = F.concat(c("p_name"), F.when(c("copy") == 1, " (copy)").otherwise(""))
        lat = degrees_text(ten_thousandths("lat0", key, 7919, 2000))
        return self._twice(self.in_both_cities("part")).select(
            "city", padded(text(key), key % 3 == 0).alias("stop_id"),
            F.when(key % 37 != 0, name).alias("stop_name"),
            F.when(key % 31 == 0, "n/a").otherwise(lat).alias("stop_lat"),
            degrees_text(ten_thousandths("lon0", key, 104729, 1999)).alias("stop_lon"),
            F.when(key % 29 == 0, "x").otherwise(text(c("p_size") % 2)).alias("location_type"),
            F.when(key % 5 == 0, padded(text(key % 7), key % 2 == 0)).alias("parent_station"),
        )

    @cached_property
    def raw_routes(self) -> DataFrame:
        key = c("c_custkey")
        name = F.concat(c("c_name"), F.when(c("copy") == 1, " (copy)").otherwise(""))
        return self._twice(self.in_both_cities("customer")).select(
            "city", F.when(key % 43 != 0, padded(text(key), key % 3 == 0)).alias("route_id"),
            F.concat(F.lit("R"), text(key)).alias("route_short_name"),
            padded(name, key % 4 == 0).alias("route_long_name"),
            F.when(key % 17 == 0, "bus").otherwise(text(key % 5)).alias("route_type"),
        )

    @cached_property
    def raw_trips(self) -> DataFrame:
        """Without the optional ``schd_trip_id``."""
        key = c("o_orderkey")
        return self._twice(self.raw("orders")).select(
            city_of("o_orderkey").alias("city"),
            F.when(key % 43 != 0, text("o_custkey")).alias("route_id"),
            F.when(key % 29 != 0, text(c("o_custkey") + c("copy"))).alias("service_id"),
            padded(text(key), key % 3 == 0).alias("trip_id"),
            F.when(key % 19 == 0, "out").otherwise(text(c("o_custkey") % 2)).alias("direction_id"),
            F.when(key % 10 != 0, text(key % 3)).alias("shape_id"),
            padded(c("o_orderstatus"), key % 2 == 0).alias("direction"),
            text(key % 3).alias("wheelchair_accessible"),
        )

    @cached_property
    def raw_stop_times(self) -> DataFrame:
        part = c("l_partkey")
        return self.raw("lineitem").select(
            city_of("l_orderkey").alias("city"),
            padded(F.lpad(text("l_orderkey"), 9, "0"), part % 3 == 0).alias("trip_id"),
            F.concat(F.lpad(text(4 + c("l_linenumber") * 3), 2, "0"), F.lit(":10:00")).alias(
                "arrival_time"
            ),
            F.concat(F.lpad(text(4 + c("l_linenumber") * 3), 2, "0"), F.lit(":11:00")).alias(
                "departure_time"
            ),
            F.when(part % 59 != 0, text(part)).alias("stop_id"),
            F.when(part % 53 == 0, "x").otherwise(text("l_linenumber")).alias("stop_sequence"),
        )

    @cached_property
    def raw_shapes(self) -> DataFrame:
        key = c("o_orderkey")
        lat = degrees_text(ten_thousandths("lat0", key, 7919, 2000))
        return self.in_both_cities("orders").select(
            "city", padded(text("o_custkey"), key % 4 == 0).alias("shape_id"),
            F.when(key % 31 == 0, "n/a").otherwise(lat).alias("shape_pt_lat"),
            degrees_text(ten_thousandths("lon0", key, 104729, 1999)).alias("shape_pt_lon"),
            F.when(key % 37 != 0, text(key)).alias("shape_pt_sequence"),
        )

    @cached_property
    def raw_roads(self) -> DataFrame:
        """Two segments share each id; the kept one is the smaller."""
        key = c("o_orderkey")
        lat, lon = (
            ten_thousandths("lat0", key, 6151, 2000), ten_thousandths("lon0", key, 3571, 1999),
        )
        return self.in_both_cities("orders").select(
            "city", text(F.floor(key / 2)).alias("osm_id"),
            padded(F.concat(F.lit("Road "), text("o_custkey")), key % 3 == 0).alias("name"),
            padded(pick(_HIGHWAYS, c("o_custkey") % len(_HIGHWAYS)), key % 2 == 0).alias("highway"),
            degrees_text(lat).alias("start_lat"), degrees_text(lon).alias("start_lon"),
            degrees_text(lat + 2).alias("end_lat"), degrees_text(lon - 4).alias("end_lon"),
            degrees_text(lat + 1).alias("mid_lat"),
            F.when(key % 31 == 0, "?").otherwise(degrees_text(lon - 2)).alias("mid_lon"),
            F.when(key % 7 != 0, F.concat(text(key % 5000), F.lit(".5"))).alias("length_m"),
        )

    @cached_property
    def raw_pois(self) -> DataFrame:
        key = c("c_custkey")
        category = pick(_CATEGORIES, key % len(_CATEGORIES))
        lat = degrees_text(ten_thousandths("lat0", key, 6151, 2000))
        return self._twice(self.in_both_cities("customer")).select(
            "city", text(key).alias("osm_id"),
            F.concat(c("c_name"), F.when(c("copy") == 1, " (copy)").otherwise("")).alias("name"),
            F.lit("amenity").alias("tag_key"), category.alias("tag_value"),
            padded(category, key % 2 == 0).alias("poi_category"),
            F.when(key % 31 == 0, "n/a").otherwise(lat).alias("lat"),
            degrees_text(ten_thousandths("lon0", key, 3571, 1999)).alias("lon"),
        )

    @cached_property
    def street_nodes(self) -> DataFrame:
        key = c("p_partkey")
        return self.in_both_cities("part").select(
            "city", key.alias("node_id"),
            degrees(ten_thousandths("lat0", key, 7919, 2000)).alias("lat"),
            degrees(ten_thousandths("lon0", key, 104729, 1999)).alias("lon"),
        )

    @cached_property
    def street_edges(self) -> DataFrame:
        """Some edges end at an unknown node, some carry a list of names and classes."""
        return self.raw("lineitem").select(
            city_of("l_orderkey").alias("city"), c("l_partkey").alias("u"),
            F.when(c("l_suppkey") % 50 == 0, -1).otherwise(c("l_suppkey")).alias("v"),
            text("l_orderkey").alias("osmid"),
            F.array(c("l_returnflag"), c("l_linestatus")).alias("name"),
            F.array(pick(_HIGHWAYS, c("l_partkey") % len(_HIGHWAYS))).alias("highway"),
            c("l_quantity").alias("length"),
        )

    @cached_property
    def map_features(self) -> DataFrame:
        """Several tags per feature; the first accepted one counts."""
        key = c("p_partkey")

        def tag(values: list[str], size: int) -> Column:
            number = key % size
            return F.when(number < len(values), pick(values, F.least(number, F.lit(len(values) - 1))))

        return self.in_both_cities("part").select(
            "city", text(key).alias("osm_id"), c("p_name").alias("name"),
            tag(["cafe", "bench", "school", "bank"], 7).alias("amenity"),
            tag(["supermarket", "books"], 5).alias("shop"),
            tag(["park", "garden", "pitch"], 6).alias("leisure"),
            tag(["museum", "hotel"], 11).alias("tourism"),
            tag(["stadium", "yes"], 3).alias("building"),
            degrees(ten_thousandths("lat0", key, 7919, 2000)).alias("lat"),
            degrees(ten_thousandths("lon0", key, 104729, 1999)).alias("lon"),
        )

    # What is computed from them.

    @cached_property
    def active_dates(self) -> DataFrame:
        return service_calendar.active_service_dates(self.calendar, self.calendar_dates)

    @cached_property
    def tables(self) -> TransitTables:
        return TransitTables(
            stops=self.stops, routes=self.routes, trips=self.trips, stop_times=self.stop_times,
            shapes=self.shapes, roads=self.roads, pois=self.pois, active_dates=self.known_dates,
        )

    @cached_property
    def known_dates(self) -> DataFrame:
        """Worked out once for days per service and days per feed."""
        return written(self.active_dates, "active-dates")

    @cached_property
    def service_days(self) -> DataFrame:
        return service_calendar.active_service_day_counts(self.active_dates)

    @cached_property
    def feed_days(self) -> DataFrame:
        return service_calendar.total_feed_days(self.active_dates)

    @cached_property
    def known_feed_days(self) -> DataFrame:
        """Worked out once for all tables with daily averages."""
        return written(service_calendar.total_feed_days(self.known_dates), "feed-days")

    @cached_property
    def events(self) -> DataFrame:
        days = service_calendar.active_service_day_counts(self.known_dates)
        return activity.schedule_events(self.stop_times, self.trips, days)

    @cached_property
    def stop_activity(self) -> DataFrame:
        return activity.stop_activity(self.events, self.known_feed_days)

    @cached_property
    def stop_activity_enriched(self) -> DataFrame:
        return activity.stop_activity_enriched(self.stops, self.stop_activity)

    @cached_property
    def route_activity(self) -> DataFrame:
        counts = activity.route_stop_counts(self.events)
        trips = activity.running_trips(self.stop_times, self.trips)
        return activity.route_activity(counts, trips, self.routes, self.known_feed_days)

    @cached_property
    def stop_activity_by_route(self) -> DataFrame:
        counts = activity.route_stop_counts(self.events)
        return activity.stop_activity_by_route(counts, self.routes, self.stops, self.known_feed_days)

    @cached_property
    def route_shapes(self) -> DataFrame:
        return activity.route_shapes(self.trips, self.routes, self.shapes)

    @cached_property
    def stop_poi_access(self) -> DataFrame:
        """Much work for few rows, and several tables are built on it: worked out once."""
        return written(access.stop_poi_access(self.stops, self.pois), "stop-poi-access")

    @cached_property
    def busiest_stops_with_poi_context(self) -> DataFrame:
        return access.busiest_stops_with_poi_context(
            self.stop_activity_enriched, self.stop_poi_access
        )

    @cached_property
    def route_poi_access(self) -> DataFrame:
        return access.route_poi_access(self.stop_activity_by_route, self.stop_poi_access)

    @cached_property
    def transit_road_coverage(self) -> DataFrame:
        return access.transit_road_coverage(self.roads, self.stops)

    @cached_property
    def analytics(self) -> AnalyticsTables:
        return AnalyticsTables(**{f.name: getattr(self, f.name) for f in fields(AnalyticsTables)})

    @cached_property
    def visits(self) -> DataFrame:
        """Counts per route and stop, worked out once for the tables of ``routed``."""
        return freed(activity.route_stop_counts(self.events), "route-stop-counts")

    @cached_property
    def routed(self) -> AnalyticsTables:
        """``analytics`` in steps, for the queries that put whole routes together from several of its tables.

        What several tables are built on is worked out once, and a step's shuffles leave the disks with it.
        """
        trips = activity.running_trips(self.stop_times, self.trips)
        by_route = activity.stop_activity_by_route(self.visits, self.routes, self.stops, self.known_feed_days)
        steps = {
            "route_activity": freed(
                activity.route_activity(self.visits, trips, self.routes, self.known_feed_days), "route-activity"
            ),
            "stop_activity_by_route": by_route,
            "route_poi_access": freed(access.route_poi_access(by_route, self.stop_poi_access), "route-poi-access"),
        }
        names = [f.name for f in fields(AnalyticsTables) if f.name not in steps]
        return AnalyticsTables(**steps, **{name: getattr(self, name) for name in names})

    @cached_property
    def routed_stops(self) -> DataFrame:
        """The context of all routes' stops: wide rows, whose joins leave the disks before they are ranked."""
        return freed(self.routed.stop_context, "stop-context")

    @cached_property
    def written(self) -> AnalyticsTables:
        """The same tables as the batch build writes them, read back.

        Written once per session, folder and state of its files: serving queries read what a run has left, and only
        the first of them pays for the run.
        """
        key = (self.spark.sparkContext.applicationId, self.sf_dir, *self.state())
        if key not in _BUILT:
            root = scratch_path(self.spark, "analytics")
            build_analytics(self.spark, self.tables, root)
            _BUILT[key] = root
        root = _BUILT[key]
        stored = {
            name: read_dataset(self.spark, root, name, schema)
            for name, schema in ANALYTICS.items()
        }
        return AnalyticsTables(stops=self.stops, pois=self.pois, **stored)
