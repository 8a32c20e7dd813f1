"""The catalog's queries in SQL, written apart from the operators, as a check on them."""

from __future__ import annotations

from transit_engine.catalog.live_queries import MEASURES
from transit_engine.constants import (
    CTA_INACTIVE_ROUTE_MESSAGE,
    AMENITY_GROUP_LABELS,
    POI_CATEGORY_LABELS,
    POI_GROUPS,
    POI_TAGS,
    ROAD_CLASSES,
    ROUTE_TYPE_LABELS,
)


def _values(names) -> str:
    return ", ".join(f"'{name}'" for name in names)


def _rounded(expression: str, digits: int = 2) -> str:
    """Decimal rounding: binary rounding differs between engines at exact ties."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def _pick(values, number: str) -> str:
    return f"list_extract([{_values(values)}], CAST({number} + 1 AS INTEGER))"


def _lat(key: str, factor: int, shift: int = 0) -> str:
    return f"(lat0 + ({key} * {factor}) % 2000 + {shift})"


def _lon(key: str, factor: int, shift: int = 0) -> str:
    return f"(lon0 + ({key} * {factor}) % 1999 + {shift})"


def _degrees(units: str) -> str:
    return f"(CAST({units} AS DOUBLE) / 10000)"


def _degrees_text(units: str) -> str:
    return (
        f"(CASE WHEN {units} < 0 THEN '-' ELSE '' END || CAST(ABS({units}) // 10000 AS VARCHAR) "
        f"|| '.' || LPAD(CAST(ABS({units}) % 10000 AS VARCHAR), 4, '0'))"
    )


def _padded(value: str, condition: str) -> str:
    return f"CASE WHEN {condition} THEN '  ' || {value} || ' ' ELSE {value} END"


def _city(key: str) -> str:
    return f"CASE WHEN {key} % 2 = 0 THEN 'boston' ELSE 'chicago' END"


_CATEGORIES = [*POI_GROUPS, "bench", "fuel"]
_HIGHWAYS = [*ROAD_CLASSES, "footway", "path"]
_POI_GROUP = "CASE poi_category " + " ".join(
    f"WHEN '{category}' THEN '{group}'" for category, group in POI_GROUPS.items()
) + " ELSE 'other' END"
_DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"12742000e0 * ASIN(LEAST(SQRT(POWER(SIN(RADIANS({lat2} - {lat1}) / 2), 2) "
        f"+ COS(RADIANS({lat1})) * COS(RADIANS({lat2})) "
        f"* POWER(SIN(RADIANS({lon2} - {lon1}) / 2), 2)), 1e0))"
    )


ACCESS_COUNTS = [
    "poi_count_within_400m", "food_poi_count_within_400m",
    "critical_service_poi_count_within_400m", "park_poi_count_within_400m",
]
ACCESS_DISTANCES = [
    "nearest_school_m", "nearest_hospital_m", "nearest_grocery_m", "nearest_park_m",
]
_ACCESS = ", ".join([*ACCESS_COUNTS, *ACCESS_DISTANCES, "poi_categories"])
_ACCESS_OUT = ", ".join([
    *ACCESS_COUNTS, *[f"{_rounded(d, 3)} AS {d}" for d in ACCESS_DISTANCES], "poi_categories",
])
_NAMES = "route_short_name, route_long_name, route_type"

# Common table expressions: the derived test tables, then the analytics tables.
BASE = {
    "cities": "SELECT * FROM (VALUES ('boston', 423000, -711500), ('chicago', 418000, -877500)) "
    "AS v(city, lat0, lon0)",
    "s_stops": f"""
        SELECT city, CAST(p_partkey AS VARCHAR) AS stop_id, p_name AS stop_name,
            {_degrees(_lat('p_partkey', 7919))} AS stop_lat,
            {_degrees(_lon('p_partkey', 104729))} AS stop_lon,
            CAST(p_size % 2 AS INTEGER) AS location_type,
            CASE WHEN p_partkey % 5 = 0 THEN CAST(p_partkey % 7 AS VARCHAR) END AS parent_station
        FROM part, cities""",
    "s_routes": """
        SELECT city, CAST(c_custkey AS VARCHAR) AS route_id,
            CASE WHEN c_custkey % 9 <> 0 THEN 'R' || c_custkey END AS route_short_name,
            CASE WHEN c_custkey % 8 <> 0 THEN c_name END AS route_long_name,
            CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
                WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4
            END AS route_type
        FROM customer, cities""",
    "s_trips": f"""
        SELECT {_city('o_orderkey')} AS city,
            CASE WHEN o_orderkey % 41 = 0 THEN 'unlisted-' || o_custkey
                ELSE CAST(o_custkey AS VARCHAR) END AS route_id,
            CASE WHEN o_orderkey % 31 = 0 THEN 'none'
                WHEN o_orderkey % 29 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS service_id,
            CAST(o_orderkey AS VARCHAR) AS trip_id,
            CAST(o_custkey % 2 AS INTEGER) AS direction_id,
            CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey || '-' || (o_orderkey % 3) END AS shape_id
        FROM orders""",
    "s_stop_times": f"""
        SELECT {_city('l_orderkey')} AS city, CAST(l_orderkey AS VARCHAR) AS trip_id,
            LPAD(CAST(4 + l_linenumber * 3 AS VARCHAR), 2, '0') || ':'
                || LPAD(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ':00' AS arrival_time,
            CASE WHEN l_suppkey % 50 = 0 THEN 'closed-' || l_partkey
                ELSE CAST(l_partkey AS VARCHAR) END AS stop_id,
            CAST(l_linenumber AS INTEGER) AS stop_sequence
        FROM lineitem""",
    "s_shapes": f"""
        SELECT city, o_custkey || '-' || (o_orderkey % 3) AS shape_id,
            {_degrees(_lat('o_orderkey', 7919))} AS shape_pt_lat,
            {_degrees(_lon('o_orderkey', 104729))} AS shape_pt_lon,
            CAST(o_orderkey % 2000000000 AS INTEGER) AS shape_pt_sequence
        FROM orders, cities""",
    "s_places": f"""
        SELECT city, CAST(c_custkey AS VARCHAR) AS osm_id, c_name AS name,
            {_pick(_CATEGORIES, f'c_custkey % {len(_CATEGORIES)}')} AS poi_category,
            {_degrees(_lat('c_custkey', 6151))} AS lat, {_degrees(_lon('c_custkey', 3571))} AS lon
        FROM customer, cities""",
    "s_pois": f"""
        SELECT *, {_POI_GROUP} AS poi_group FROM s_places
        WHERE poi_category IN ({_values(POI_GROUPS)})""",
    "s_roads": f"""
        SELECT * FROM (
            SELECT city, CAST(o_orderkey AS VARCHAR) AS osm_id,
                {_pick(_HIGHWAYS, f'o_custkey % {len(_HIGHWAYS)}')} AS highway,
                {_degrees(_lat('o_orderkey', 6151))} AS mid_lat,
                {_degrees(_lon('o_orderkey', 3571))} AS mid_lon,
                CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice / 1000 END AS length_m
            FROM orders, cities)
        WHERE highway IN ({_values(ROAD_CLASSES)})""",
    "s_calendar": f"""
        SELECT city, CAST(c_custkey AS VARCHAR) AS service_id,
            {', '.join(f'CAST(c_custkey // {1 << i} % 2 AS INTEGER) AS {day}' for i, day in enumerate(_DAYS))},
            DATE '2024-01-01' + CAST(c_nationkey AS INTEGER) AS first_date,
            DATE '2024-01-01' + CAST(c_nationkey + c_custkey % 28 - 2 AS INTEGER) AS last_date
        FROM customer, cities""",
    "s_calendar_dates": """
        SELECT city, CAST(c_custkey AS VARCHAR) AS service_id,
            DATE '2024-01-01' + CAST((c_custkey * (k + 1)) % 45 AS INTEGER) AS service_date,
            CAST(1 + (c_custkey + k) % 2 AS INTEGER) AS exception_type
        FROM customer, cities, (VALUES (0), (1), (2)) AS v(k)""",
    "live_events": f"""
        SELECT event_id, user_id, event_type, ts, {_city('user_id')} AS city, 'veh-' || user_id AS vehicle_id,
            CASE WHEN user_id % 17 <> 0 THEN CAST(user_id % 40 AS VARCHAR) END AS route_id,
            'Route ' || (user_id % 40) AS route_label,
            CAST(event_id % 500 AS VARCHAR) AS trip_id, CAST(event_id % 300 AS VARCHAR) AS stop_id,
            CASE WHEN user_id % 7 = 0 THEN '' ELSE 'L' || user_id END AS label,
            CAST(CASE WHEN user_id % 2 = 0 THEN 423000 ELSE 418000 END
                + event_id // 3 * 37 % 2000 AS DOUBLE) / 10000 AS latitude,
            CAST(CASE WHEN user_id % 2 = 0 THEN -711500 ELSE -877500 END
                + event_id // 3 * 53 % 1999 AS DOUBLE) / 10000 AS longitude,
            CAST(event_id % 360 AS DOUBLE) AS bearing, value AS speed,
            CASE event_type WHEN 'view' THEN 'IN_TRANSIT_TO' WHEN 'click' THEN 'STOPPED_AT'
                WHEN 'purchase' THEN 'INCOMING_AT' END AS current_status,
            CAST(NULL AS VARCHAR) AS occupancy_status,
            CAST(user_id % 2 AS INTEGER) AS direction_id, CAST(user_id % 5 AS INTEGER) AS route_type,
            CASE WHEN event_id % 11 <> 0 THEN ts END AS updated_at,
            CASE WHEN event_id % 13 <> 0 THEN ts END AS feed_timestamp, 'test' AS source,
            event_id * 2 + CASE WHEN event_id % 17 = 0 THEN 101 ELSE 0 END AS seq
        FROM events""",
    "s_live": "SELECT * EXCLUDE (event_id, user_id, event_type, ts) FROM live_events",
    "weekday_dates": f"""
        SELECT city, service_id, service_date FROM (
            SELECT *, UNNEST(generate_series(CAST(first_date AS TIMESTAMP),
                CAST(last_date AS TIMESTAMP), INTERVAL 1 DAY))::DATE AS service_date
            FROM s_calendar WHERE first_date <= last_date)
        WHERE list_extract([sunday, {', '.join(_DAYS[:6])}],
            CAST(dayofweek(service_date) + 1 AS INTEGER)) = 1""",
    "active_dates": """
        SELECT d.* FROM (
            SELECT * FROM weekday_dates
            UNION
            SELECT city, service_id, service_date FROM s_calendar_dates WHERE exception_type = 1) d
        WHERE NOT EXISTS (SELECT 1 FROM s_calendar_dates x WHERE x.exception_type = 2
            AND x.city = d.city AND x.service_id = d.service_id AND x.service_date = d.service_date)""",
    "day_counts": """
        SELECT city, service_id, COUNT(DISTINCT service_date) AS active_service_days
        FROM active_dates GROUP BY city, service_id""",
    "feed_days": """
        SELECT city, GREATEST(COUNT(DISTINCT service_date), 1) AS feed_days
        FROM active_dates GROUP BY city""",
    "visits": """
        SELECT st.city, st.trip_id, st.stop_id, t.route_id,
            COALESCE(d.active_service_days, 1) AS days
        FROM s_stop_times st
        JOIN s_trips t ON t.city = st.city AND t.trip_id = st.trip_id
        LEFT JOIN day_counts d ON d.city = t.city AND d.service_id = t.service_id""",
    "stop_activity": f"""
        SELECT v.city, stop_id, COUNT(*) AS trip_count,
            {_rounded('SUM(days) / COALESCE(MAX(feed_days), 1)')} AS avg_daily_stop_events
        FROM visits v LEFT JOIN feed_days f ON f.city = v.city GROUP BY v.city, stop_id""",
    "stop_activity_enriched": """
        SELECT a.city, a.stop_id, s.stop_name, s.stop_lat, s.stop_lon, a.trip_count,
            a.avg_daily_stop_events, s.location_type, s.parent_station
        FROM stop_activity a JOIN s_stops s ON s.city = a.city AND s.stop_id = a.stop_id""",
    "route_activity": f"""
        SELECT v.city, v.route_id, {_NAMES}, COUNT(*) AS stop_event_count,
            COUNT(DISTINCT trip_id) AS distinct_trip_count,
            COUNT(DISTINCT stop_id) AS distinct_stop_count,
            {_rounded('SUM(days) / COALESCE(MAX(feed_days), 1)')} AS avg_daily_stop_events
        FROM visits v JOIN s_routes r ON r.city = v.city AND r.route_id = v.route_id
        LEFT JOIN feed_days f ON f.city = v.city
        GROUP BY v.city, v.route_id, {_NAMES}""",
    "stop_activity_by_route": f"""
        SELECT v.city, v.route_id, {_NAMES}, v.stop_id, stop_name, stop_lat, stop_lon,
            COUNT(*) AS trip_count,
            {_rounded('SUM(days) / COALESCE(MAX(feed_days), 1)')} AS avg_daily_stop_events
        FROM visits v JOIN s_routes r ON r.city = v.city AND r.route_id = v.route_id
        JOIN s_stops s ON s.city = v.city AND s.stop_id = v.stop_id
        LEFT JOIN feed_days f ON f.city = v.city
        GROUP BY v.city, v.route_id, {_NAMES}, v.stop_id, stop_name, stop_lat, stop_lon""",
    "route_shapes": f"""
        SELECT t.city, t.route_id, {_NAMES}, t.shape_id, shape_pt_sequence, shape_pt_lat,
            shape_pt_lon
        FROM (SELECT DISTINCT city, route_id, shape_id FROM s_trips WHERE shape_id IS NOT NULL) t
        JOIN s_routes r ON r.city = t.city AND r.route_id = t.route_id
        JOIN s_shapes s ON s.city = t.city AND s.shape_id = t.shape_id""",
    "poi_pairs": f"""
        SELECT s.city, stop_id, stop_name, stop_lat, stop_lon, osm_id, poi_category, poi_group,
            {haversine('stop_lat', 'stop_lon', 'lat', 'lon')} AS distance_m
        FROM s_stops s JOIN s_pois p ON p.city = s.city
            AND ABS(stop_lat - lat) < 4e-3 AND ABS(stop_lon - lon) < 5e-3
        WHERE {haversine('stop_lat', 'stop_lon', 'lat', 'lon')} <= 400""",
    "stop_poi_access": """
        SELECT city, stop_id, stop_name, stop_lat, stop_lon,
            COUNT(*) AS poi_count_within_400m,
            COUNT(*) FILTER (poi_group = 'food') AS food_poi_count_within_400m,
            COUNT(*) FILTER (poi_group IN ('healthcare', 'education', 'grocery'))
                AS critical_service_poi_count_within_400m,
            COUNT(*) FILTER (poi_group = 'park') AS park_poi_count_within_400m,
            MIN(distance_m) FILTER (poi_category IN ('school', 'university', 'college'))
                AS nearest_school_m,
            MIN(distance_m) FILTER (poi_category IN ('hospital', 'clinic')) AS nearest_hospital_m,
            MIN(distance_m) FILTER (poi_group = 'grocery') AS nearest_grocery_m,
            MIN(distance_m) FILTER (poi_group = 'park') AS nearest_park_m,
            STRING_AGG(DISTINCT poi_category, ', ' ORDER BY poi_category) AS poi_categories
        FROM poi_pairs GROUP BY city, stop_id, stop_name, stop_lat, stop_lon""",
    "busiest": f"""
        SELECT a.city, a.stop_id, a.stop_name, a.stop_lat, a.stop_lon, trip_count,
            avg_daily_stop_events, {_ACCESS}
        FROM stop_activity_enriched a
        LEFT JOIN stop_poi_access p ON p.city = a.city AND p.stop_id = a.stop_id""",
    "route_poi_access": f"""
        SELECT r.city, route_id, {_NAMES}, COUNT(DISTINCT r.stop_id) AS stop_count,
            CAST(SUM(COALESCE(poi_count_within_400m, 0)) AS BIGINT) AS total_poi_access,
            {_rounded('AVG(poi_count_within_400m)')} AS avg_poi_access_per_stop,
            MAX(poi_count_within_400m) AS max_poi_access_at_stop,
            COUNT(DISTINCT r.stop_id) FILTER (nearest_hospital_m IS NOT NULL) AS stops_near_hospital,
            COUNT(DISTINCT r.stop_id) FILTER (nearest_grocery_m IS NOT NULL) AS stops_near_grocery,
            COUNT(DISTINCT r.stop_id) FILTER (nearest_park_m IS NOT NULL) AS stops_near_park
        FROM stop_activity_by_route r
        LEFT JOIN stop_poi_access p ON p.city = r.city AND p.stop_id = r.stop_id
        GROUP BY r.city, route_id, {_NAMES}""",
    "covered_roads": f"""
        SELECT DISTINCT r.city, r.osm_id FROM s_roads r JOIN s_stops s ON s.city = r.city
            AND ABS(mid_lat - stop_lat) < 2e-3 AND ABS(mid_lon - stop_lon) < 3e-3
        WHERE {haversine('mid_lat', 'mid_lon', 'stop_lat', 'stop_lon')} <= 200""",
    "road_coverage": f"""
        SELECT r.city, highway, COUNT(*) AS total_road_segments,
            NULLIF(COUNT(c.osm_id), 0) AS road_segments_near_transit,
            {_rounded('NULLIF(COUNT(c.osm_id), 0) / COUNT(*) * 100')} AS coverage_pct,
            {_rounded('SUM(length_m) / 1000')} AS total_length_km,
            {_rounded('SUM(length_m) FILTER (c.osm_id IS NOT NULL) / 1000')} AS covered_length_km
        FROM s_roads r LEFT JOIN covered_roads c ON c.city = r.city AND c.osm_id = r.osm_id
        GROUP BY r.city, highway""",
    "route_summary": """
        SELECT a.*, stop_count, total_poi_access, avg_poi_access_per_stop, max_poi_access_at_stop,
            stops_near_hospital, stops_near_grocery, stops_near_park
        FROM route_activity a
        LEFT JOIN route_poi_access p ON p.city = a.city AND p.route_id = a.route_id""",
    "context": f"""
        SELECT r.*, {_ACCESS} FROM stop_activity_by_route r
        LEFT JOIN stop_poi_access p ON p.city = r.city AND p.stop_id = r.stop_id""",
    "ranked_stops": """
        SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY city, route_id
            ORDER BY avg_daily_stop_events DESC NULLS LAST, trip_count DESC NULLS LAST,
                poi_count_within_400m DESC NULLS LAST, stop_id) AS INTEGER) AS stop_rank
        FROM context""",
    "paths": """
        SELECT city, route_id, shape_id, shape_pt_sequence, shape_pt_lon AS lon,
            shape_pt_lat AS lat,
            COUNT(*) OVER (PARTITION BY city, route_id, shape_id) AS points
        FROM route_shapes QUALIFY points >= 2""",
    "overview": f"""
        SELECT s.city, total_stops, COALESCE(total_routes, 0) AS total_routes,
            COALESCE(total_stop_events, 0) AS total_stop_events,
            COALESCE(daily, 0) AS avg_daily_stop_events,
            COALESCE(with_poi, 0) AS stops_with_poi_context,
            {_rounded('COALESCE(poi_sum, 0) / NULLIF(total_stops, 0)')} AS avg_poi_access_per_stop
        FROM (SELECT city, COUNT(*) AS total_stops FROM s_stops GROUP BY city) s
        LEFT JOIN (SELECT city, COUNT(*) AS total_routes FROM route_activity GROUP BY city) r
            ON r.city = s.city
        LEFT JOIN (SELECT city, CAST(SUM(trip_count) AS BIGINT) AS total_stop_events,
            {_rounded('SUM(avg_daily_stop_events)')} AS daily
            FROM stop_activity GROUP BY city) a ON a.city = s.city
        LEFT JOIN (SELECT city, COUNT(*) AS with_poi, SUM(poi_count_within_400m) AS poi_sum
            FROM stop_poi_access GROUP BY city) p ON p.city = s.city""",
    "mix_amenity": """
        SELECT city, poi_group, COUNT(*) AS amenity_count FROM s_pois GROUP BY city, poi_group""",
    "mix_mode": """
        SELECT city, route_type, COUNT(*) AS route_count,
            CAST(COALESCE(SUM(stop_event_count), 0) AS BIGINT) AS stop_event_count
        FROM route_activity GROUP BY city, route_type""",
    "live_timed": """
        SELECT *, GREATEST(COALESCE(epoch_us(updated_at) // 1000, 0),
            COALESCE(epoch_us(feed_timestamp) // 1000, 0)) AS ts_ms FROM s_live""",
    "live_changelog": """
        SELECT * FROM live_timed QUALIFY ts_ms = MAX(ts_ms) OVER (
            PARTITION BY city, vehicle_id ORDER BY seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "live_snapshot": """
        SELECT * FROM live_timed QUALIFY ROW_NUMBER() OVER (
            PARTITION BY city, vehicle_id ORDER BY ts_ms DESC, seq DESC) = 1""",
    "live_merged": """
        SELECT * FROM s_live QUALIFY ROW_NUMBER() OVER (
            PARTITION BY city, vehicle_id ORDER BY seq DESC) = 1""",
}


def _first(columns: str, keys: str, source: str, where: str) -> str:
    """Typed rows that pass, one per key: the smallest by the other columns, nulls first."""
    names = [part.strip() for part in columns.split(",")]
    rest = [name for name in names if name not in keys.split(", ")]
    order = ", ".join(f"{name} ASC NULLS FIRST" for name in rest)
    return (
        f"SELECT {columns} FROM ({source}) WHERE {where} QUALIFY ROW_NUMBER() OVER "
        f"(PARTITION BY {keys} ORDER BY {order}) = 1"
    )


_COPY = "(VALUES (0), (1)) AS k(copy)"
_COPY_NAME = "CASE WHEN copy = 1 THEN ' (copy)' ELSE '' END"
_RAW_TRIPS = f"""
    SELECT {_city('o_orderkey')} AS city,
        CASE WHEN o_orderkey % 43 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS route_id,
        CASE WHEN o_orderkey % 29 <> 0 THEN CAST(o_custkey + copy AS VARCHAR) END AS service_id,
        TRIM({_padded('CAST(o_orderkey AS VARCHAR)', 'o_orderkey % 3 = 0')}) AS trip_id,
        TRY_CAST(CASE WHEN o_orderkey % 19 = 0 THEN 'out'
            ELSE CAST(o_custkey % 2 AS VARCHAR) END AS INTEGER) AS direction_id,
        CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey % 3 AS VARCHAR) END AS shape_id,
        TRIM({_padded('o_orderstatus', 'o_orderkey % 2 = 0')}) AS direction,
        CAST(o_orderkey % 3 AS INTEGER) AS wheelchair_accessible,
        CAST(NULL AS VARCHAR) AS schd_trip_id,
        {_padded('CAST(o_orderkey AS VARCHAR)', 'o_orderkey % 3 = 0')} AS raw_trip_id
    FROM orders, {_COPY}"""
_TAGS = {
    "amenity": (["cafe", "bench", "school", "bank"], 7),
    "shop": (["supermarket", "books"], 5),
    "leisure": (["park", "garden", "pitch"], 6),
    "tourism": (["museum", "hotel"], 11),
    "building": (["stadium", "yes"], 3),
}
_TAG_COLUMNS = ", ".join(
    f"CASE WHEN p_partkey % {size} < {len(values)} THEN {_pick(values, f'p_partkey % {size}')} END"
    f" AS {tag}"
    for tag, (values, size) in _TAGS.items()
)
_ACCEPTED = {tag: f"{tag} IN ({_values(values)})" for tag, values in POI_TAGS.items()}
_SEGMENTS = f"""
    SELECT e.city, e.osm_id, e.name, e.highway, a.lat AS start_lat, a.lon AS start_lon,
        b.lat AS end_lat, b.lon AS end_lon, (a.lat + b.lat) / 2 AS mid_lat,
        (a.lon + b.lon) / 2 AS mid_lon, e.length_m
    FROM (SELECT {_city('l_orderkey')} AS city, l_partkey AS u,
            CASE WHEN l_suppkey % 50 = 0 THEN -1 ELSE l_suppkey END AS v,
            CAST(l_orderkey AS VARCHAR) AS osm_id, l_returnflag AS name,
            {_pick(_HIGHWAYS, f'l_partkey % {len(_HIGHWAYS)}')} AS highway,
            l_quantity AS length_m FROM lineitem) e
    LEFT JOIN nodes a ON a.city = e.city AND a.node_id = e.u
    LEFT JOIN nodes b ON b.city = e.city AND b.node_id = e.v"""
_NODES = f"""nodes AS (
    SELECT city, p_partkey AS node_id, {_degrees(_lat('p_partkey', 7919))} AS lat,
        {_degrees(_lon('p_partkey', 104729))} AS lon FROM part, cities)"""

# Queries that need common tables of their own name them in "WITH" form; see ``sql``.
# Pieces of five points, the last of which begins the next piece.
_PIECES = """placed AS (
            SELECT city, route_id, shape_id, lon, lat, ROW_NUMBER() OVER (
                PARTITION BY city, route_id, shape_id ORDER BY shape_pt_sequence, lon, lat) - 1 AS n FROM paths
        ), dealt AS (
            SELECT *, n // 4 AS piece FROM placed
            UNION ALL SELECT *, n // 4 - 1 FROM placed WHERE n % 4 = 0 AND n > 0
        ), pieces AS (
            SELECT city, route_id, shape_id, CAST(piece AS INTEGER) AS piece, n, lon, lat FROM dealt
            QUALIFY COUNT(*) OVER (PARTITION BY city, route_id, shape_id, piece) >= 2)"""
FINAL: dict[str, str] = {
    "clean_stops": _first(
        "city, stop_id, stop_name, stop_lat, stop_lon, location_type, parent_station",
        "city, stop_id",
        f"""SELECT city, CAST(p_partkey AS VARCHAR) AS stop_id,
            CASE WHEN p_partkey % 37 <> 0 THEN p_name || {_COPY_NAME} END AS stop_name,
            TRY_CAST(CASE WHEN p_partkey % 31 = 0 THEN 'n/a'
                ELSE {_degrees_text(_lat('p_partkey', 7919))} END AS DOUBLE) AS stop_lat,
            TRY_CAST({_degrees_text(_lon('p_partkey', 104729))} AS DOUBLE) AS stop_lon,
            CASE WHEN p_partkey % 29 <> 0 THEN CAST(p_size % 2 AS INTEGER) END AS location_type,
            CASE WHEN p_partkey % 5 = 0 THEN CAST(p_partkey % 7 AS VARCHAR) END AS parent_station
        FROM part, cities, {_COPY}""",
        "stop_name IS NOT NULL AND stop_lat IS NOT NULL AND stop_lon IS NOT NULL",
    ),
    "clean_routes": _first(
        "city, route_id, route_short_name, route_long_name, route_type",
        "city, route_id",
        f"""SELECT city, CASE WHEN c_custkey % 43 <> 0 THEN CAST(c_custkey AS VARCHAR) END
                AS route_id,
            'R' || c_custkey AS route_short_name, c_name || {_COPY_NAME} AS route_long_name,
            CASE WHEN c_custkey % 17 <> 0 THEN CAST(c_custkey % 5 AS INTEGER) END AS route_type
        FROM customer, cities, {_COPY}""",
        "route_id IS NOT NULL",
    ),
    "clean_trips": _first(
        "city, route_id, service_id, trip_id, direction_id, shape_id, direction, "
        "wheelchair_accessible, schd_trip_id",
        "city, trip_id", _RAW_TRIPS, "route_id IS NOT NULL AND trip_id IS NOT NULL",
    ),
    "optional_string_column": f"SELECT raw_trip_id AS trip_id, direction, schd_trip_id FROM ({_RAW_TRIPS})",
    "clean_stop_times": f"""
        SELECT {_city('l_orderkey')} AS city, LPAD(CAST(l_orderkey AS VARCHAR), 9, '0') AS trip_id,
            LPAD(CAST(4 + l_linenumber * 3 AS VARCHAR), 2, '0') || ':10:00' AS arrival_time,
            LPAD(CAST(4 + l_linenumber * 3 AS VARCHAR), 2, '0') || ':11:00' AS departure_time,
            CAST(l_partkey AS VARCHAR) AS stop_id, CAST(l_linenumber AS INTEGER) AS stop_sequence
        FROM lineitem WHERE l_partkey % 59 <> 0 AND l_partkey % 53 <> 0""",
    "clean_shapes": f"""
        SELECT city, CAST(o_custkey AS VARCHAR) AS shape_id,
            TRY_CAST({_degrees_text(_lat('o_orderkey', 7919))} AS DOUBLE) AS shape_pt_lat,
            TRY_CAST({_degrees_text(_lon('o_orderkey', 104729))} AS DOUBLE) AS shape_pt_lon,
            CAST(o_orderkey AS INTEGER) AS shape_pt_sequence
        FROM orders, cities WHERE o_orderkey % 31 <> 0 AND o_orderkey % 37 <> 0""",
    "clean_roads": _first(
        "city, osm_id, name, highway, start_lat, start_lon, end_lat, end_lon, mid_lat, mid_lon, "
        "length_m",
        "city, osm_id",
        f"""SELECT city, CAST(o_orderkey // 2 AS VARCHAR) AS osm_id, 'Road ' || o_custkey AS name,
            {_pick(_HIGHWAYS, f'o_custkey % {len(_HIGHWAYS)}')} AS highway,
            CAST({_degrees_text(_lat('o_orderkey', 6151))} AS DOUBLE) AS start_lat,
            CAST({_degrees_text(_lon('o_orderkey', 3571))} AS DOUBLE) AS start_lon,
            CAST({_degrees_text(_lat('o_orderkey', 6151, 2))} AS DOUBLE) AS end_lat,
            CAST({_degrees_text(_lon('o_orderkey', 3571, -4))} AS DOUBLE) AS end_lon,
            CAST({_degrees_text(_lat('o_orderkey', 6151, 1))} AS DOUBLE) AS mid_lat,
            CASE WHEN o_orderkey % 31 <> 0 THEN
                CAST({_degrees_text(_lon('o_orderkey', 3571, -2))} AS DOUBLE) END AS mid_lon,
            CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 5000) + 0.5e0 END AS length_m
        FROM orders, cities""",
        f"mid_lon IS NOT NULL AND highway IN ({_values(ROAD_CLASSES)})",
    ),
    "clean_pois": f"""
        SELECT city, osm_id, name, tag_key, tag_value, poi_category, {_POI_GROUP} AS poi_group,
            lat, lon
        FROM (""" + _first(
        "city, osm_id, name, tag_key, tag_value, poi_category, lat, lon",
        "city, osm_id",
        f"""SELECT city, osm_id, name || {_COPY_NAME} AS name, 'amenity' AS tag_key,
            poi_category AS tag_value, poi_category, lat, lon
        FROM s_places, {_COPY} WHERE CAST(osm_id AS BIGINT) % 31 <> 0""",
        f"poi_category IN ({_values(POI_GROUPS)})",
    ) + ")",
    "poi_group": f"""
        SELECT poi_category, COUNT(*) * 2 AS places, {_POI_GROUP} AS poi_group
        FROM s_places GROUP BY poi_category""",
    "derive_road_segments": f"WITH {_NODES} {_SEGMENTS}",
    "classify_pois": f"""
        SELECT city, osm_id, name, tag_key, tag_value, tag_value AS poi_category, lat, lon
        FROM (SELECT *,
            CASE {' '.join(f"WHEN {test} THEN '{tag}'" for tag, test in _ACCEPTED.items())} END
                AS tag_key,
            CASE {' '.join(f"WHEN {test} THEN {tag}" for tag, test in _ACCEPTED.items())} END
                AS tag_value
            FROM (SELECT city, CAST(p_partkey AS VARCHAR) AS osm_id, p_name AS name, {_TAG_COLUMNS},
                {_degrees(_lat('p_partkey', 7919))} AS lat,
                {_degrees(_lon('p_partkey', 104729))} AS lon
                FROM part, cities))
        WHERE tag_key IS NOT NULL""",
    "service_calendar_expand": (
        "SELECT city, service_id, CAST(service_date AS VARCHAR) AS service_date FROM weekday_dates"
    ),
    "service_exceptions": """
        SELECT city, service_id, CAST(service_date AS VARCHAR) AS service_date, exception_type
        FROM s_calendar_dates""",
    "active_service_dates": (
        "SELECT city, service_id, CAST(service_date AS VARCHAR) AS service_date FROM active_dates"
    ),
    "active_service_day_counts": "SELECT * FROM day_counts",
    "total_feed_days": "SELECT * FROM feed_days",
    "stop_activity": "SELECT * FROM stop_activity",
    "stop_activity_enriched": "SELECT * FROM stop_activity_enriched",
    "route_activity": "SELECT * FROM route_activity",
    "stop_activity_by_route": "SELECT * FROM stop_activity_by_route",
    "route_shapes": "SELECT * FROM route_shapes",
    "stop_poi_access": f"""
        SELECT city, stop_id, stop_name, stop_lat, stop_lon, {_ACCESS_OUT} FROM stop_poi_access""",
    "busiest_stops_with_poi_context": f"""
        SELECT city, stop_id, stop_name, stop_lat, stop_lon, trip_count, avg_daily_stop_events,
            {_ACCESS_OUT} FROM busiest""",
    "route_poi_access": "SELECT * FROM route_poi_access",
    "transit_road_coverage": "SELECT * FROM road_coverage",
    "stop_activity_raw": """
        SELECT CASE WHEN l_partkey % 59 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS stop_id,
            COUNT(*) AS trip_count FROM lineitem GROUP BY 1""",
    "legacy_stop_activity_enriched": """
        SELECT a.city || '/' || a.stop_id AS stop_id, stop_name, stop_lat, stop_lon, trip_count,
            location_type, parent_station
        FROM (SELECT city, stop_id, COUNT(*) AS trip_count FROM s_stop_times GROUP BY ALL) a
        JOIN s_stops s ON s.city = a.city AND s.stop_id = a.stop_id""",
    "legacy_route_activity": f"""
        SELECT city || '/' || route_id AS route_id, {_NAMES}, stop_event_count,
            distinct_trip_count, distinct_stop_count FROM route_activity""",
    "legacy_stop_activity_by_route": """
        SELECT city || '/' || route_id AS route_id, route_short_name, route_long_name,
            city || '/' || stop_id AS stop_id, stop_name, stop_lat, stop_lon, trip_count
        FROM stop_activity_by_route""",
    "legacy_route_shapes": f"""
        SELECT city || '/' || route_id AS route_id, {_NAMES}, city || '/' || shape_id AS shape_id,
            shape_pt_sequence, shape_pt_lat, shape_pt_lon FROM route_shapes""",
    "haversine_distance": f"""WITH {_NODES}
        SELECT city, osm_id, start_lat, start_lon, end_lat, end_lon,
            {_rounded(haversine('start_lat', 'start_lon', 'end_lat', 'end_lon'), 3)} AS distance_m
        FROM ({_SEGMENTS})""",
    "bbox_distance_join": f"""
        SELECT city, stop_id, COUNT(*) AS pairs,
            MIN({_rounded('distance_m', 3)}) AS nearest_m,
            MAX({_rounded('distance_m', 3)}) AS farthest_m,
            CAST(SUM(FLOOR(distance_m)) AS BIGINT) AS whole_metres
        FROM poi_pairs GROUP BY city, stop_id""",
}


# Sort orders of the ranked reports.
_ORDERS = {
    "activity": "avg_daily_stop_events DESC NULLS LAST, trip_count DESC NULLS LAST, "
    "poi_count_within_400m DESC NULLS LAST, stop_id",
    "poi": "poi_count_within_400m DESC, food_poi_count_within_400m DESC, stop_id",
    "routes": "avg_daily_stop_events DESC, stop_event_count DESC, distinct_trip_count DESC, "
    "route_id",
    "routes_poi": "total_poi_access DESC NULLS LAST, avg_poi_access_per_stop DESC NULLS LAST, "
    "route_id",
    "roads": "coverage_pct DESC NULLS LAST, total_length_km DESC NULLS LAST, highway",
    "amenity": "amenity_count DESC, poi_group",
    "mode": "stop_event_count DESC, route_type NULLS LAST",
    "catalog": "avg_daily_stop_events DESC, stop_event_count DESC, route_short_name NULLS LAST, "
    "route_long_name NULLS LAST, route_id",
}


def _top(columns: str, source: str, order: str, limit: int) -> str:
    return (
        f"SELECT {columns} FROM {source} QUALIFY ROW_NUMBER() OVER "
        f"(PARTITION BY city ORDER BY {_ORDERS[order]}) <= {limit}"
    )


def _ranked(section: str, item: str, value: str, source: str, order: str, limit: int) -> str:
    return (
        f"SELECT city, '{section}' AS section, CAST(ROW_NUMBER() OVER (PARTITION BY city ORDER BY "
        f"{_ORDERS[order]}) AS INTEGER) AS position, CAST({item} AS VARCHAR) AS item, "
        f"CAST({value} AS DOUBLE) AS value FROM {source} QUALIFY position <= {limit}"
    )


_DASHBOARD = " UNION ALL ".join([
    _ranked("top_stops_by_activity", "stop_id", "avg_daily_stop_events", "busiest", "activity", 200),
    _ranked("top_stops_by_poi", "stop_id", "poi_count_within_400m", "stop_poi_access", "poi", 200),
    _ranked("top_routes_by_activity", "route_id", "avg_daily_stop_events", "route_activity",
            "routes", 25),
    _ranked("top_routes_by_poi", "route_id", "total_poi_access", "route_poi_access", "routes_poi",
            25),
    _ranked("road_coverage", "highway", "coverage_pct", "road_coverage", "roads", 500),
    _ranked("amenity_mix", "poi_group", "amenity_count", "mix_amenity", "amenity", 500),
    _ranked("route_mode_mix", "route_type", "stop_event_count", "mix_mode", "mode", 500),
])
_FEATURED = f"({_top('city, route_id', 'route_activity', 'catalog', 1)})"
_DETAIL = f"""
    SELECT city, route_id, 'stop' AS part, '' AS shape_id, stop_rank AS position,
        stop_lat AS lat, stop_lon AS lon
    FROM ranked_stops WHERE stop_rank <= 80 AND (city, route_id) IN {_FEATURED}
    UNION ALL
    SELECT city, route_id, 'path', shape_id, CAST(ROW_NUMBER() OVER (PARTITION BY city, route_id,
        shape_id ORDER BY shape_pt_sequence) AS INTEGER), lat, lon
    FROM paths WHERE (city, route_id) IN {_FEATURED}"""
_CITY_ROWS = (
    "(VALUES ('boston', 'Boston', 42.3601e0, -71.0589e0, 11.2e0, TRUE, TRUE), "
    "('chicago', 'Chicago', 41.8781e0, -87.6298e0, 10.6e0, TRUE, TRUE)) AS d(city, display_name, "
    "latitude, longitude, zoom, supports_batch, supports_live)"
)
_ROLLUP = f"""
    SELECT city, route_id, COALESCE(NULLIF(stop_name, ''), stop_id) AS stop_key,
        FIRST(stop_id ORDER BY stop_rank) AS stop_id, FIRST(stop_name ORDER BY stop_rank) AS stop_name,
        FIRST(stop_lat ORDER BY stop_rank) AS stop_lat, FIRST(stop_lon ORDER BY stop_rank) AS stop_lon,
        COUNT(*) AS stop_instances, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
        {_rounded('SUM(avg_daily_stop_events)')} AS avg_daily_stop_events,
        {', '.join(f'COALESCE(MAX({n}), 0) AS {n}' for n in ACCESS_COUNTS)},
        COALESCE(ARRAY_TO_STRING(LIST_SORT(LIST_DISTINCT(FLATTEN(LIST(
            STRING_SPLIT(poi_categories, ', ')) FILTER (poi_categories IS NOT NULL)))), ', '), '')
            AS poi_categories
    FROM ranked_stops GROUP BY city, route_id, stop_key"""
_AVG_OR_TRIPS = "COALESCE(NULLIF(avg_daily_stop_events, 0), trip_count, 0)"
_CATEGORY_CASE = "CASE x " + " ".join(
    f"WHEN '{key}' THEN '{label}'" for key, label in POI_CATEGORY_LABELS.items()
) + " ELSE REPLACE(x, '_', ' ') END"


def _case(column: str, labels: dict, other: str) -> str:
    return f"CASE {column} " + " ".join(
        f"WHEN {key!r} THEN '{label}'" for key, label in labels.items()
    ) + f" ELSE {other} END"


_TIER = """CASE WHEN ratio > 0.75e0 THEN 3 WHEN ratio > 0.45e0 THEN 2 WHEN ratio > 0.2e0 THEN 1
    ELSE 0 END"""


def _lens(lens: str, score: str) -> str:
    return f"""
        SELECT city, stop_id, '{lens}' AS lens, {_TIER} AS tier FROM (
            SELECT city, stop_id, COALESCE({score} / NULLIF(MAX({score}) OVER (PARTITION BY city),
                0), 0) AS ratio FROM busiest)"""


_SHOWN = """
    SELECT city, stop_id, stop_name, trip_count, stop_lat, stop_lon FROM stop_activity_enriched
    WHERE trip_count >= 18
    QUALIFY ROW_NUMBER() OVER (PARTITION BY city ORDER BY trip_count DESC, stop_id) <= 300"""


def _needs(column: str, noun: str) -> str:
    return f"CASE WHEN {column} > 0 THEN format('{{:,}}', {column}) || ' {noun}' END"


def _picked(section: str, item: str, source: str, order: str, limit: int) -> str:
    return (
        f"SELECT city, '{section}' AS section, '' AS route_id, CAST(ROW_NUMBER() OVER (PARTITION "
        f"BY city ORDER BY {_ORDERS[order]}) AS INTEGER) AS position, "
        f"CAST({item} AS VARCHAR) AS item FROM {source} QUALIFY position <= {limit}"
    )


_ROUTE_COLUMNS = (
    f"city, route_id, {_NAMES}, stop_event_count, distinct_trip_count, distinct_stop_count, "
    "avg_daily_stop_events"
)
FINAL |= {
    "top_stops_activity": _top(
        f"city, stop_id, stop_name, stop_lat, stop_lon, trip_count, avg_daily_stop_events, "
        f"{_ACCESS_OUT}", "busiest", "activity", 200,
    ),
    "top_stops_poi": _top(
        f"city, stop_id, stop_name, stop_lat, stop_lon, {_ACCESS_OUT}", "stop_poi_access", "poi",
        200,
    ),
    "top_routes_activity": _top(_ROUTE_COLUMNS, "route_activity", "routes", 25),
    "top_routes_poi": _top("*", "route_poi_access", "routes_poi", 25),
    "road_coverage_report": "SELECT * FROM road_coverage",
    "amenity_mix": "SELECT * FROM mix_amenity",
    "route_mode_mix": "SELECT * FROM mix_mode",
    "route_catalog": _top(_ROUTE_COLUMNS, "route_activity", "catalog", 500),
    "route_summary": "SELECT * FROM route_summary",
    "route_stop_context": f"""
        SELECT city, route_id, {_NAMES}, stop_id, stop_name, stop_lat, stop_lon, trip_count,
            avg_daily_stop_events, {_ACCESS_OUT} FROM context""",
    "route_top_stops": f"""
        SELECT city, route_id, {_NAMES}, stop_id, stop_name, stop_lat, stop_lon, trip_count,
            avg_daily_stop_events, {_ACCESS_OUT}, stop_rank
        FROM ranked_stops WHERE stop_rank <= 12""",
    "route_preview": """
        SELECT s.city, s.route_id, s.stop_event_count, s.total_poi_access, stop_rank, r.stop_id,
            r.trip_count
        FROM route_summary s LEFT JOIN ranked_stops r
            ON r.city = s.city AND r.route_id = s.route_id AND stop_rank <= 12""",
    "route_shape_points": f"""
        SELECT city, route_id, shape_id, shape_pt_sequence, shape_pt_lat, shape_pt_lon
        FROM route_shapes WHERE city = 'boston' AND (city, route_id) IN {_FEATURED}""",
    "route_path_points": """
        SELECT city, route_id, shape_id, shape_pt_sequence, lon, lat FROM paths""",
    "route_paths": """
        SELECT city, route_id, shape_id, CAST(ROW_NUMBER() OVER (PARTITION BY city, route_id, shape_id
            ORDER BY shape_pt_sequence, lon, lat) - 1 AS INTEGER) AS place, lon, lat FROM paths""",
    "route_path_pieces": f"""
        WITH {_PIECES}
        SELECT city, route_id, shape_id, piece, CAST(ROW_NUMBER() OVER (
            PARTITION BY city, route_id, shape_id, piece ORDER BY n) - 1 AS INTEGER) AS place, lon, lat
        FROM pieces""",
    "route_detail_parts": f"""
        WITH {_PIECES}
        SELECT a.city, a.route_id, 0 AS part, stop_event_count,
            CAST(LEAST((SELECT COUNT(*) FROM stop_activity_by_route r
                WHERE r.city = a.city AND r.route_id = a.route_id), 80) AS INTEGER) AS stops,
            NULL AS shape_id, NULL AS piece, NULL AS points
        FROM route_activity a
        UNION ALL
        SELECT city, route_id, CAST(ROW_NUMBER() OVER (
            PARTITION BY city, route_id ORDER BY shape_id, piece) AS INTEGER) AS part, NULL, NULL, shape_id,
            piece, CAST(COUNT(*) AS INTEGER)
        FROM pieces WHERE (city, route_id) IN (SELECT (city, route_id) FROM route_activity)
        GROUP BY city, route_id, shape_id, piece""",
    "route_detail": _DETAIL,
    "city_overview": "SELECT * FROM overview",
    "busiest_stop": """
        SELECT city, stop_name, trip_count, avg_daily_stop_events FROM stop_activity_enriched
        QUALIFY ROW_NUMBER() OVER (PARTITION BY city
            ORDER BY avg_daily_stop_events DESC, trip_count DESC, stop_id) = 1""",
    "busiest_route": """
        SELECT city, route_id, route_short_name, route_long_name, stop_event_count,
            avg_daily_stop_events FROM route_activity
        QUALIFY ROW_NUMBER() OVER (PARTITION BY city
            ORDER BY avg_daily_stop_events DESC, stop_event_count DESC, route_id) = 1""",
    "poi_leader": _top(
        f"city, stop_name, {', '.join(ACCESS_COUNTS)}, poi_categories", "stop_poi_access", "poi", 1
    ),
    "city_dimension": f"""
        SELECT d.*, vehicles FROM {_CITY_ROWS} LEFT JOIN (
            SELECT city, COUNT(DISTINCT vehicle_id) AS vehicles FROM s_live GROUP BY city) v
            ON v.city = d.city""",
    "city_comparison": f"""
        SELECT o.city, display_name, total_stops, total_routes, total_stop_events,
            avg_daily_stop_events, stops_with_poi_context, avg_poi_access_per_stop,
            busiest_stop, busiest_route, poi_leader
        FROM overview o JOIN {_CITY_ROWS} ON d.city = o.city
        JOIN (SELECT city, FIRST(stop_name ORDER BY avg_daily_stop_events DESC, trip_count DESC,
                stop_id) AS busiest_stop FROM stop_activity_enriched GROUP BY city) a
            ON a.city = o.city
        JOIN (SELECT city, FIRST(route_id ORDER BY avg_daily_stop_events DESC,
                stop_event_count DESC, route_id) AS busiest_route
            FROM route_activity GROUP BY city) b ON b.city = o.city
        JOIN (SELECT city, FIRST(stop_name ORDER BY {_ORDERS['poi']}) AS poi_leader
            FROM stop_poi_access GROUP BY city) p ON p.city = o.city""",
    "city_dashboard": _DASHBOARD,
    "city_snapshot": f"""
        SELECT city, 'dashboard' AS part, COUNT(*) AS entries FROM ({_DASHBOARD}) GROUP BY city
        UNION ALL SELECT city, 'routes', LEAST(COUNT(*), 500) FROM route_activity GROUP BY city
        UNION ALL SELECT r.city, 'preview_stops', COUNT(*) FROM ranked_stops r
            JOIN route_activity a ON a.city = r.city AND a.route_id = r.route_id
            WHERE stop_rank <= 12 GROUP BY r.city
        UNION ALL SELECT city, 'featured', COUNT(*) FROM ({_DETAIL}) GROUP BY city""",
    "bootstrap_snapshot": f"""
        SELECT d.city, display_name, total_stops, total_routes, a.city || ':' || a.route_id AS key,
            stop_event_count,
            (SELECT CAST(COUNT(*) AS INTEGER) FROM ranked_stops r WHERE r.city = a.city
                AND r.route_id = a.route_id AND stop_rank <= 80) AS stops,
            (SELECT CAST(COUNT(DISTINCT shape_id) AS INTEGER) FROM paths p WHERE p.city = a.city
                AND p.route_id = a.route_id) AS paths
        FROM {_CITY_ROWS} JOIN overview o ON o.city = d.city
        JOIN route_activity a ON a.city = d.city
        WHERE (a.city, a.route_id) IN {_FEATURED}""",
    "bootstrap_contents": f"""
        {_DASHBOARD}
        UNION ALL (SELECT city, 'routes', 0, route_id, CAST(stop_event_count AS DOUBLE) FROM route_activity
            QUALIFY ROW_NUMBER() OVER (PARTITION BY city ORDER BY {_ORDERS['catalog']}) <= 500)
        UNION ALL SELECT r.city, 'preview:' || r.route_id, CAST(r.stop_rank AS INTEGER), r.stop_id,
            CAST(r.trip_count AS DOUBLE)
        FROM ranked_stops r JOIN route_activity a ON a.city = r.city AND a.route_id = r.route_id
        WHERE r.stop_rank <= 12""",
    "records_normalise": FINAL["stop_poi_access"],
    "route_stop_rollup": _ROLLUP,
    "share_of_total": f"""
        SELECT city, poi_group, {_rounded('n / t', 6)} AS share,
            {_rounded('(u - n) / t', 6)} AS share_start, {_rounded('u / t', 6)} AS share_end
        FROM (SELECT city, poi_group, amenity_count AS n,
            SUM(amenity_count) OVER (PARTITION BY city) AS t,
            SUM(amenity_count) OVER (PARTITION BY city ORDER BY amenity_count DESC, poi_group) AS u
            FROM mix_amenity)""",
    "ratio_to_max": f"""
        SELECT city, route_id, {_rounded('stop_event_count / MAX(stop_event_count) OVER '
            '(PARTITION BY city) * 100', 6)} AS width_pct FROM route_activity""",
    "availability_tier": f"""
        SELECT city, stop_id, {_rounded('ratio', 6)} AS ratio,
            CASE WHEN ratio >= 0.82e0 THEN 'very high' WHEN ratio >= 0.55e0 THEN 'high'
                WHEN ratio >= 0.28e0 THEN 'moderate' ELSE 'lower' END AS tier
        FROM (SELECT city, stop_id, {_AVG_OR_TRIPS} / MAX({_AVG_OR_TRIPS}) OVER
            (PARTITION BY city) AS ratio FROM stop_activity_enriched)""",
    "lens_score_tier": _lens("service", "COALESCE(avg_daily_stop_events, trip_count, 0)")
    + " UNION ALL " + _lens("access", "COALESCE(poi_count_within_400m, 0)"),
    "trip_count_tier": """
        SELECT city, route_id, stop_event_count * 20 AS trip_count,
            CASE WHEN stop_event_count * 20 < 500 THEN 'lower'
                WHEN stop_event_count * 20 < 1000 THEN 'medium'
                WHEN stop_event_count * 20 < 1500 THEN 'high' ELSE 'very high' END AS tier
        FROM route_activity""",
    "route_extent": f"""
        SELECT city, route_id, {_rounded('a', 6)} AS min_lon, {_rounded('b', 6)} AS max_lon,
            {_rounded('c', 6)} AS min_lat, {_rounded('d', 6)} AS max_lat,
            {_rounded('(c + d) / 2', 6)} AS latitude, {_rounded('(a + b) / 2', 6)} AS longitude,
            {_rounded('span', 6)} AS span,
            CASE WHEN span > 0.7e0 THEN 9.6e0 WHEN span > 0.45e0 THEN 10.3e0
                WHEN span > 0.2e0 THEN 11e0 WHEN span > 0.08e0 THEN 11.8e0
                WHEN span > 0.03e0 THEN 12.8e0 ELSE 12.3e0 END AS zoom
        FROM (SELECT *, GREATEST(b - a, d - c) AS span FROM (
            SELECT city, route_id, MIN(lon) AS a, MAX(lon) AS b, MIN(lat) AS c, MAX(lat) AS d
            FROM (SELECT city, route_id, stop_lon AS lon, stop_lat AS lat
                    FROM stop_activity_by_route
                UNION ALL SELECT city, route_id, lon, lat FROM paths)
            GROUP BY city, route_id))""",
    "finite_coordinates": f"""WITH {_NODES}
        SELECT city, osm_id, end_lon, end_lat FROM ({_SEGMENTS}) WHERE end_lon IS NOT NULL""",
    "display_topk": " UNION ALL ".join([
        _picked("amenity_mix", "poi_group", "mix_amenity", "amenity", 6),
        _picked("mode_mix", "route_type", "mix_mode", "mode", 5),
        _picked("stops", "stop_id", "busiest", "activity", 8),
        _picked("stops_poi", "stop_id", "stop_poi_access", "poi", 8),
        _picked("routes", "route_id", "route_activity", "routes", 8),
        f"""SELECT city, 'route_stops', route_id, CAST(ROW_NUMBER() OVER (PARTITION BY city,
            route_id ORDER BY poi_count_within_400m DESC, trip_count DESC, stop_key) AS INTEGER)
            AS position, stop_key FROM ({_ROLLUP}) QUALIFY position <= 8""",
    ]),
    "stop_display_label": f"""
        SELECT city, route_id, stop_key, stop_key || CASE WHEN stop_instances > 1
            THEN ' (' || stop_instances || ' platforms)' ELSE '' END AS display_label
        FROM ({_ROLLUP})""",
    "labels": f"""
        SELECT city, stop_id,
            COALESCE(ARRAY_TO_STRING(LIST_TRANSFORM(STRING_SPLIT(poi_categories, ', ')[1:4],
                lambda x: {_CATEGORY_CASE}), ', '), '') AS category_labels,
            COALESCE(NULLIF(CONCAT_WS(' · ',
                {_needs('food_poi_count_within_400m', 'food options')},
                {_needs('critical_service_poi_count_within_400m',
                        'schools, healthcare, or groceries')},
                {_needs('park_poi_count_within_400m', 'park/garden/play features')}), ''),
                'No matched daily-needs POIs within 400m') AS daily_needs
        FROM busiest""",
    "labels_routes": f"""
        SELECT city, route_id, COALESCE(NULLIF(CONCAT_WS(' — ', route_short_name,
            route_long_name), ''), route_id) AS route_label,
            {_case('route_type', ROUTE_TYPE_LABELS, "'Transit'")} AS mode
        FROM s_routes""",
    "labels_amenities": f"""
        SELECT city, {_case('poi_group', AMENITY_GROUP_LABELS, 'poi_group')} AS label,
            amenity_count FROM mix_amenity""",
    "labels_vehicles": """
        SELECT seq, COALESCE(NULLIF(label, ''), vehicle_id) AS vehicle,
            CASE WHEN current_status = 'IN_TRANSIT_TO' THEN 'In transit'
                WHEN current_status = 'STOPPED_AT' AND city = 'chicago' AND route_type = 3
                    THEN 'Delayed'
                WHEN current_status = 'STOPPED_AT' THEN 'Stopped'
                WHEN current_status = 'INCOMING_AT' THEN 'Approaching stop'
                WHEN city = 'chicago' AND route_type = 3 THEN 'Reporting live'
                ELSE 'Unknown' END AS status
        FROM s_live""",
    "stops_over_threshold": _SHOWN,
    "stops_over_threshold_kpis": f"""
        SELECT city, COUNT(*) AS stops_shown, MAX(trip_count) AS max_trip_count,
            {_rounded('AVG(trip_count)', 1)} AS mean_trip_count FROM ({_SHOWN}) GROUP BY city""",
    "route_options": """
        SELECT DISTINCT city, route_id, route_short_name, route_long_name,
            COALESCE(route_short_name, route_id) || ' - ' || COALESCE(route_long_name, '')
                AS route_label
        FROM stop_activity_by_route""",
    "route_stops_over_threshold": f"""
        SELECT city, route_id, stop_id, trip_count,
            CAST(ROW_NUMBER() OVER (PARTITION BY city, route_id ORDER BY trip_count DESC, stop_id)
                AS INTEGER) AS place
        FROM stop_activity_by_route WHERE trip_count >= 2""",
    "live_route_options": """
        SELECT DISTINCT city, route_id FROM s_live WHERE route_id IS NOT NULL""",
    "live_kpis": """
        SELECT city, COUNT(*) AS vehicles_shown, COUNT(DISTINCT route_id) AS routes_active,
            'all' AS filter FROM s_live GROUP BY city
        UNION ALL SELECT city, COUNT(*) FILTER (route_id = '7'), COUNT(DISTINCT route_id), '7'
            FROM s_live GROUP BY city""",
}



# Live records. Instants are compared as epoch microseconds.
_TIMED = (
    "city, vehicle_id, route_id, route_label, trip_id, stop_id, label, latitude, longitude, "
    "bearing, speed, current_status, occupancy_status, direction_id, route_type, "
    "epoch_us(updated_at) AS updated_at, epoch_us(feed_timestamp) AS feed_timestamp, source"
)
_NONE = "CAST(NULL AS VARCHAR)"


def _line(dataset: str, source: str, fields: list[str]) -> str:
    """The raw rows of a table as city, table and its fields in one text."""
    told = " || '|' || ".join(f"COALESCE({field}, '~')" for field in fields)
    return f"SELECT city, '{dataset}' AS dataset, {told} AS line FROM {source}"


def _text(number: str) -> str:
    return f"CAST({number} AS VARCHAR)"


_RAW_LINES = {
    "stops": (f"part, cities, {_COPY}", [
        _padded(_text("p_partkey"), "p_partkey % 3 = 0"),
        f"CASE WHEN p_partkey % 37 <> 0 THEN p_name || {_COPY_NAME} END",
        f"CASE WHEN p_partkey % 31 = 0 THEN 'n/a' ELSE {_degrees_text(_lat('p_partkey', 7919))} END",
        _degrees_text(_lon("p_partkey", 104729)),
        f"CASE WHEN p_partkey % 29 = 0 THEN 'x' ELSE {_text('p_size % 2')} END",
        f"CASE WHEN p_partkey % 5 = 0 THEN {_padded(_text('p_partkey % 7'), 'p_partkey % 2 = 0')} END",
    ]),
    "routes": (f"customer, cities, {_COPY}", [
        f"CASE WHEN c_custkey % 43 <> 0 THEN {_padded(_text('c_custkey'), 'c_custkey % 3 = 0')} END",
        "'R' || c_custkey", _padded(f"(c_name || {_COPY_NAME})", "c_custkey % 4 = 0"),
        f"CASE WHEN c_custkey % 17 = 0 THEN 'bus' ELSE {_text('c_custkey % 5')} END",
    ]),
    "trips": (f"(SELECT *, {_city('o_orderkey')} AS city FROM orders), {_COPY}", [
        f"CASE WHEN o_orderkey % 43 <> 0 THEN {_text('o_custkey')} END",
        f"CASE WHEN o_orderkey % 29 <> 0 THEN {_text('o_custkey + copy')} END",
        _padded(_text("o_orderkey"), "o_orderkey % 3 = 0"),
        f"CASE WHEN o_orderkey % 19 = 0 THEN 'out' ELSE {_text('o_custkey % 2')} END",
        f"CASE WHEN o_orderkey % 10 <> 0 THEN {_text('o_orderkey % 3')} END",
        _padded("o_orderstatus", "o_orderkey % 2 = 0"), _text("o_orderkey % 3"),
    ]),
    "stop_times": (f"(SELECT *, {_city('l_orderkey')} AS city FROM lineitem)", [
        _padded(f"LPAD({_text('l_orderkey')}, 9, '0')", "l_partkey % 3 = 0"),
        f"LPAD({_text('4 + l_linenumber * 3')}, 2, '0') || ':10:00'",
        f"LPAD({_text('4 + l_linenumber * 3')}, 2, '0') || ':11:00'",
        f"CASE WHEN l_partkey % 59 <> 0 THEN {_text('l_partkey')} END",
        f"CASE WHEN l_partkey % 53 = 0 THEN 'x' ELSE {_text('l_linenumber')} END",
    ]),
    "shapes": ("orders, cities", [
        _padded(_text("o_custkey"), "o_orderkey % 4 = 0"),
        f"CASE WHEN o_orderkey % 31 = 0 THEN 'n/a' ELSE {_degrees_text(_lat('o_orderkey', 7919))} END",
        _degrees_text(_lon("o_orderkey", 104729)),
        f"CASE WHEN o_orderkey % 37 <> 0 THEN {_text('o_orderkey')} END",
    ]),
    "roads": ("orders, cities", [
        _text("o_orderkey // 2"), _padded("('Road ' || o_custkey)", "o_orderkey % 3 = 0"),
        _padded(_pick(_HIGHWAYS, f"o_custkey % {len(_HIGHWAYS)}"), "o_orderkey % 2 = 0"),
        _degrees_text(_lat("o_orderkey", 6151)), _degrees_text(_lon("o_orderkey", 3571)),
        _degrees_text(_lat("o_orderkey", 6151, 2)), _degrees_text(_lon("o_orderkey", 3571, -4)),
        _degrees_text(_lat("o_orderkey", 6151, 1)),
        f"CASE WHEN o_orderkey % 31 = 0 THEN '?' ELSE {_degrees_text(_lon('o_orderkey', 3571, -2))} END",
        f"CASE WHEN o_orderkey % 7 <> 0 THEN {_text('o_orderkey % 5000')} || '.5' END",
    ]),
    "pois": (f"customer, cities, {_COPY}", [
        _text("c_custkey"), f"c_name || {_COPY_NAME}", "'amenity'",
        _pick(_CATEGORIES, f"c_custkey % {len(_CATEGORIES)}"),
        _padded(_pick(_CATEGORIES, f"c_custkey % {len(_CATEGORIES)}"), "c_custkey % 2 = 0"),
        f"CASE WHEN c_custkey % 31 = 0 THEN 'n/a' ELSE {_degrees_text(_lat('c_custkey', 6151))} END",
        _degrees_text(_lon("c_custkey", 3571)),
    ]),
}
# Chicago winter time; the test events all lie in January.
_LOCAL_TO_UTC_US = "+ 21600000000"
_MBTA_RECORDS = """
    SELECT 'boston' AS city, vehicle_id, route_id,
        CASE WHEN route_id IS NOT NULL THEN CASE WHEN user_id % 40 % 3 = 0 THEN 'S' || user_id % 40
            ELSE 'S' || user_id % 40 || ' - Line ' || user_id % 40 END END AS route_label,
        trip_id, CAST(NULL AS VARCHAR) AS stop_id, label, latitude, longitude, bearing,
        CASE WHEN event_id % 5 <> 0 THEN speed END AS speed, current_status, occupancy_status,
        direction_id, CASE WHEN route_id IS NOT NULL THEN CAST(user_id % 5 AS INTEGER) END
            AS route_type,
        epoch_us(updated_at) AS updated_at, epoch_us(updated_at) AS feed_timestamp,
        'mbta_v3' AS source
    FROM live_events WHERE event_id % 23 <> 0"""
_BUS_RECORDS = f"""
    SELECT 'chicago' AS city, 'bus-' || user_id AS vehicle_id, rt AS route_id,
        CASE WHEN rt IS NULL THEN 'To ' || trip_id
            ELSE rt || ' - ' || CASE WHEN named THEN 'Line ' || rt ELSE 'To ' || trip_id END END
            AS route_label,
        trip_id, {_NONE} AS stop_id, CAST(user_id AS VARCHAR) AS label, latitude, longitude,
        CASE WHEN event_id % 5 <> 0 THEN bearing END AS bearing, NULL::DOUBLE AS speed,
        CASE WHEN event_type = 'click' THEN 'STOPPED_AT' END AS current_status,
        {_NONE} AS occupancy_status, NULL::INTEGER AS direction_id, 3 AS route_type,
        epoch_us(local_time) {_LOCAL_TO_UTC_US} AS updated_at,
        epoch_us(local_time) {_LOCAL_TO_UTC_US} AS feed_timestamp, 'cta_bus_tracker' AS source
    FROM (SELECT *, CASE WHEN user_id % 17 <> 0 THEN CAST(user_id % 40 AS VARCHAR) END AS rt,
            user_id % 40 % 4 <> 0 AS named,
            CASE WHEN event_id % 19 <> 0 THEN DATE_TRUNC(
                CASE WHEN event_id % 2 = 0 THEN 'second' ELSE 'minute' END, ts) END AS local_time
        FROM live_events)
    WHERE event_id % 23 <> 0 AND event_id % 29 <> 0 AND event_id // 100 NOT IN (
        SELECT event_id // 100 FROM events WHERE event_id % 701 = 5)"""
_TRAIN_RECORDS = f"""
    SELECT 'chicago' AS city, 'train-' || user_id AS vehicle_id, line AS route_id,
        CASE line WHEN 'red' THEN 'Red' WHEN 'g' THEN 'G' ELSE 'Pink' END || ' Line'
            || CASE WHEN event_id % 5 <> 0 THEN ' - To ' || trip_id ELSE '' END AS route_label,
        {_NONE} AS trip_id, stop_id, CAST(user_id AS VARCHAR) AS label, latitude, longitude,
        bearing, NULL::DOUBLE AS speed,
        CASE WHEN event_id % 3 = 0 THEN 'INCOMING_AT' ELSE 'IN_TRANSIT_TO' END AS current_status,
        {_NONE} AS occupancy_status,
        CASE WHEN event_id % 7 <> 0 THEN CAST(user_id % 2 AS INTEGER) END AS direction_id,
        1 AS route_type, epoch_us(DATE_TRUNC('second', ts)) {_LOCAL_TO_UTC_US} AS updated_at,
        epoch_us(DATE_TRUNC('second', ts)) {_LOCAL_TO_UTC_US} AS feed_timestamp,
        'cta_train_tracker' AS source
    FROM (SELECT *, CASE event_id % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'g' ELSE 'pink' END AS line
        FROM live_events)
    WHERE event_id % 23 <> 0 AND event_id % 29 <> 0
        AND NOT (event_id // 100 % 13 = 4)"""
_NOW = """(SELECT MAX(COALESCE(epoch_us(updated_at), epoch_us(feed_timestamp), 0))
    FROM live_snapshot)"""
_STATE = """(SELECT *, COALESCE(epoch_us(updated_at), epoch_us(feed_timestamp), 0) AS upserted_at
    FROM live_snapshot)"""
_TTL_US = 86_400 * 1_000_000
# Three batches of the accepted arrivals at 12:00:00, 12:00:20 and 12:00:40; records live for 30 seconds.
_BATCHED = """(SELECT *, CAST(LEAST(FLOOR(seq * 3 / (1 + (SELECT MAX(seq) FROM live_changelog))), 2) AS BIGINT) AS batch
    FROM live_changelog)"""
_NOON_US = 1_717_243_200_000_000
FINAL |= {
    "scan_mbta_payload": """
        SELECT CAST(event_id // 100 AS VARCHAR) AS payload_id, 'veh-' || user_id AS vehicle_id,
            CASE WHEN user_id % 17 <> 0 THEN CAST(user_id % 40 AS VARCHAR) END AS route_id,
            CASE WHEN user_id % 17 <> 0 THEN 'S' || user_id % 40 END AS short_name
        FROM events""",
    "scan_cta_bus_payload": f"""
        SELECT CAST(event_id // 100 AS VARCHAR) AS payload_id, 'vehicle' AS kind,
            CASE WHEN user_id % 17 <> 0 THEN CAST(user_id % 40 AS VARCHAR) END AS rt,
            CASE WHEN event_id % 29 = 0 THEN ' ' ELSE {_padded('CAST(user_id AS VARCHAR)', 'event_id % 7 = 0')}
                END AS name,
            CASE WHEN event_type <> 'click' THEN 'false' WHEN event_id % 2 = 0 THEN 'true' ELSE 'True' END AS dly,
            CASE WHEN event_id % 5 <> 0 THEN bearing END AS hdg,
            CASE WHEN event_id % 23 <> 0 THEN latitude END AS lat
        FROM live_events
        UNION ALL
        SELECT CAST(event_id // 100 AS VARCHAR), 'error',
            CASE WHEN event_id % 701 <> 5 THEN CAST(user_id % 40 AS VARCHAR) END,
            CASE WHEN event_id % 701 = 5 THEN 'Internal error' ELSE '{CTA_INACTIVE_ROUTE_MESSAGE}' END, NULL, NULL, NULL
        FROM events WHERE event_id % 97 = 0 OR event_id % 701 = 5
        UNION ALL
        SELECT DISTINCT CAST(event_id // 100 AS VARCHAR), 'route', CAST(user_id % 40 AS VARCHAR),
            'Line ' || user_id % 40, NULL, NULL::DOUBLE, NULL::DOUBLE
        FROM events WHERE user_id % 17 <> 0 AND user_id % 40 % 4 <> 0""",
    "scan_cta_train_payload": f"""
        SELECT CAST(event_id // 100 AS VARCHAR) AS payload_id,
            CASE event_id % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'g' ELSE 'pink' END AS line_name,
            CASE WHEN event_id % 29 = 0 THEN '' ELSE {_padded('CAST(user_id AS VARCHAR)', 'event_id % 7 = 0')}
                END AS rn,
            CASE WHEN event_id % 5 <> 0 THEN 'To ' || trip_id END AS "destNm", stop_id AS "nextStpId",
            CASE WHEN event_id % 3 = 0 THEN '1' ELSE '0' END AS "isApp",
            CASE WHEN event_id % 7 = 0 THEN 'x' ELSE CAST(user_id % 2 AS VARCHAR) END AS "trDr",
            CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                ELSE strftime(ts, '%Y%m%d %H:%M:%S') END AS prdt
        FROM live_events WHERE NOT (event_id // 100 % 13 = 4)""",
    "normalize_mbta": _MBTA_RECORDS,
    "normalize_cta_bus": _BUS_RECORDS,
    "normalize_cta_train": _TRAIN_RECORDS,
    "parse_local_timestamp": f"""
        SELECT event_id, CASE WHEN event_id % 19 <> 0 THEN epoch_us(DATE_TRUNC(
            CASE WHEN event_id % 2 = 0 THEN 'second' ELSE 'minute' END, ts))
            {_LOCAL_TO_UTC_US} END AS instant
        FROM events""",
    "bus_feed_errors": """
        SELECT CAST(event_id // 100 AS VARCHAR) AS payload_id,
            CASE WHEN event_id % 701 = 5 THEN 'rejected' ELSE 'inactive' END AS kind,
            CASE WHEN event_id % 701 <> 5 THEN CAST(user_id % 40 AS VARCHAR) END AS rt
        FROM events WHERE event_id % 97 = 0 OR event_id % 701 = 5""",
    "active_bus_routes": """
        SELECT CAST(seen.rt AS VARCHAR) AS rt FROM (
            SELECT user_id % 40 AS rt, MAX(event_id // 100) AS poll FROM events
            WHERE user_id % 17 <> 0 GROUP BY 1) seen
        LEFT JOIN (
            SELECT user_id % 40 AS rt, MAX(event_id // 100) AS poll FROM events
            WHERE event_id % 97 = 0 AND event_id % 701 <> 5 GROUP BY 1) gone ON gone.rt = seen.rt
        WHERE gone.poll IS NULL OR seen.poll > gone.poll""",
    "dedupe_latest": f"""
        SELECT {_TIMED}, seq FROM s_live QUALIFY ROW_NUMBER() OVER (PARTITION BY city, vehicle_id
            ORDER BY COALESCE(updated_at, feed_timestamp) DESC NULLS LAST,
            CASE WHEN COALESCE(updated_at, feed_timestamp) IS NULL THEN -seq ELSE seq END DESC)
            = 1""",
    "live_union": f"{_BUS_RECORDS} UNION ALL {_TRAIN_RECORDS}",
    "latest_vehicle_changelog": f"SELECT {_TIMED}, seq, ts_ms FROM live_changelog",
    "latest_vehicle_snapshot": f"SELECT {_TIMED}, seq, ts_ms FROM live_snapshot",
    "vehicle_snapshot_merge": f"SELECT {_TIMED}, seq FROM live_merged",
    "list_vehicles": f"""
        SELECT city, vehicle_id, route_id, label, upserted_at FROM {_STATE}
        WHERE {_NOW} - upserted_at < {_TTL_US}""",
    "live_health": f"""
        SELECT city, COUNT(*) FILTER ({_NOW} - upserted_at < {_TTL_US}) AS vehicle_count,
            MAX(upserted_at) AS last_upsert_at,
            FIRST(vehicle_id ORDER BY upserted_at DESC, seq DESC) AS last_vehicle_id
        FROM {_STATE} GROUP BY city""",
    "vehicle_update_gap": """
        SELECT city, vehicle_id, seq,
            COALESCE(latitude <> LAG(latitude) OVER w OR longitude <> LAG(longitude) OVER w, FALSE)
                AS moved,
            CASE WHEN epoch_us(updated_at) // 1000 > epoch_us(LAG(updated_at) OVER w) // 1000
                THEN LEAST(GREATEST(epoch_us(updated_at) // 1000
                    - epoch_us(LAG(updated_at) OVER w) // 1000, 900), 3200)
                ELSE 1800 END AS gap_ms
        FROM s_live WINDOW w AS (PARTITION BY city, vehicle_id ORDER BY seq)""",
    "stream_raw": f"SELECT seq, {_TIMED} FROM s_live",
    "stream_latest": f"SELECT seq, {_TIMED} FROM live_changelog",
    "stream_sink_raw": f"SELECT seq, {_TIMED} FROM s_live",
    "stream_sink_latest": f"SELECT seq, {_TIMED} FROM live_changelog",
    "latest_vehicle_stream": "SELECT city, vehicle_id, seq, ts_ms FROM live_changelog",
    "live_state_upsert": f"""
        SELECT {_TIMED}, seq FROM live_changelog QUALIFY ROW_NUMBER() OVER (
            PARTITION BY city, vehicle_id ORDER BY seq DESC) = 1""",
    "keyed_latest_stream": "SELECT city, vehicle_id, seq, ts_ms, route_id FROM live_changelog",
    "live_state_expiry": f"""
        SELECT {_TIMED}, seq, {_NOON_US} + batch * 20000000 AS upserted_at FROM (
            SELECT * FROM {_BATCHED} QUALIFY ROW_NUMBER() OVER (
                PARTITION BY city, vehicle_id ORDER BY batch DESC, seq DESC) = 1)
        WHERE batch >= 1""",
    "live_health_after_expiry": f"""
        WITH newest AS (
            SELECT *, MAX(batch) OVER (PARTITION BY city, vehicle_id) AS last_batch FROM {_BATCHED}
        ), told AS (
            SELECT city, COUNT(DISTINCT vehicle_id) FILTER (last_batch >= 1) AS alive,
                {_NOON_US} + MAX(batch) * 20000000 AS last_upsert_at,
                FIRST(vehicle_id ORDER BY batch DESC, seq DESC) AS last_vehicle_id
            FROM newest GROUP BY city)
        SELECT city, alive AS vehicle_count, last_upsert_at, last_vehicle_id, 'at once' AS asked FROM told
        UNION ALL
        SELECT city, 0, last_upsert_at, last_vehicle_id, 'when all are over' FROM told""",
    "scan_gtfs": "\nUNION ALL ".join(_line(name, *_RAW_LINES[name]) for name in (
        "stops", "routes", "trips", "stop_times", "shapes")),
    "scan_osm": _line("roads", *_RAW_LINES["roads"]) + "\nUNION ALL " + _line("pois", *_RAW_LINES["pois"]),
    "clean_without_city": "\nUNION ALL ".join(
        f"SELECT 'both' AS city, '{name}' AS dataset, COUNT(*) AS row_count, "
        f"CAST(SUM(FLOOR({measure})) AS BIGINT) AS measure FROM ({FINAL[f'clean_{name}']})"
        for name, measure in (
            ("stops", "location_type"), ("routes", "route_type"), ("trips", "direction_id"),
            ("stop_times", "stop_sequence"), ("shapes", "shape_pt_sequence"), ("roads", "length_m"), ("pois", "lon"),
        )),
    "scan_gtfs_stop_times": f"""
        SELECT {_city('l_orderkey')} AS city,
            CASE WHEN l_partkey % 3 = 0 THEN '  ' || LPAD(CAST(l_orderkey AS VARCHAR), 9, '0') || ' '
                ELSE LPAD(CAST(l_orderkey AS VARCHAR), 9, '0') END AS trip_id,
            LPAD(CAST(4 + l_linenumber * 3 AS VARCHAR), 2, '0') || ':10:00' AS arrival_time,
            LPAD(CAST(4 + l_linenumber * 3 AS VARCHAR), 2, '0') || ':11:00' AS departure_time,
            CASE WHEN l_partkey % 59 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS stop_id,
            CASE WHEN l_partkey % 53 = 0 THEN 'x' ELSE CAST(l_linenumber AS VARCHAR) END
                AS stop_sequence
        FROM lineitem""",
    "scan_calendar": """
        SELECT city, service_id, CAST(service_date AS VARCHAR) AS service_date FROM active_dates""",
    "scan_osm_counts": """
        SELECT city, COUNT(*) AS segments, COUNT(DISTINCT osm_id) AS ids FROM (
            SELECT city, o_orderkey // 2 AS osm_id FROM orders, cities) GROUP BY city""",
    "write_dataset": "SELECT * FROM stop_activity",
    "legacy_load": "\nUNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, COUNT(*) AS row_count, CAST(SUM({measure}) AS BIGINT) AS measure, "
        f"COUNT(DISTINCT {key}) AS ids FROM {source}"
        for dataset, measure, key, source in (
            ("stops", "location_type", "(city, stop_id)", "s_stops"),
            ("routes", "route_type", "(city, route_id)", "s_routes"),
            ("trips", "direction_id", "(city, route_id)", "s_trips"),
            ("stop_times", "stop_sequence", "(city, trip_id)", "s_stop_times"),
            ("shapes", "shape_pt_sequence", "(city, shape_id)", "s_shapes"),
            ("stop_activity", "n", "(city, stop_id)",
             "(SELECT city, stop_id, COUNT(*) AS n FROM s_stop_times GROUP BY ALL)"),
            ("stop_activity_enriched", "trip_count", "stop_id", f"({FINAL['legacy_stop_activity_enriched']})"),
            ("route_activity", "distinct_trip_count", "route_id", f"({FINAL['legacy_route_activity']})"),
            ("stop_activity_by_route", "trip_count", "route_id", f"({FINAL['legacy_stop_activity_by_route']})"),
            ("route_shapes", "shape_pt_sequence", "route_id", f"({FINAL['legacy_route_shapes']})"),
        )),
    "legacy_load_stops": """
        SELECT a.city || '/' || a.stop_id AS STOP_ID, stop_name AS STOP_NAME, stop_lat AS STOP_LAT,
            stop_lon AS STOP_LON, trip_count AS TRIP_COUNT, location_type AS LOCATION_TYPE,
            parent_station AS PARENT_STATION
        FROM (SELECT city, stop_id, COUNT(*) AS trip_count FROM s_stop_times GROUP BY ALL) a
        JOIN s_stops s ON s.city = a.city AND s.stop_id = a.stop_id""",
    "build_analytics": """
        SELECT 'stop_activity' AS dataset, COUNT(*) AS row_count FROM stop_activity
        UNION ALL SELECT 'stop_activity_enriched', COUNT(*) FROM stop_activity_enriched
        UNION ALL SELECT 'route_activity', COUNT(*) FROM route_activity
        UNION ALL SELECT 'stop_activity_by_route', COUNT(*) FROM stop_activity_by_route
        UNION ALL SELECT 'route_shapes', COUNT(*) FROM route_shapes
        UNION ALL SELECT 'stop_poi_access', COUNT(*) FROM stop_poi_access
        UNION ALL SELECT 'busiest_stops_with_poi_context', COUNT(*) FROM busiest
        UNION ALL SELECT 'route_poi_access', COUNT(*) FROM route_poi_access
        UNION ALL SELECT 'transit_road_coverage', COUNT(*) FROM road_coverage""",
}



# Where the analytics tables of the common part go by another name.
_TABLES = {"busiest_stops_with_poi_context": "busiest", "transit_road_coverage": "road_coverage"}
_CLEAN = ["stops", "routes", "trips", "stop_times", "shapes", "roads", "pois"]


def _raw_to_warehouse() -> str:
    """The common tables again, over cleaned raw tables instead of ready-made clean ones."""
    cleaned = {f"s_{name}": FINAL[f"clean_{name}"] for name in _CLEAN}
    cleaned["s_stop_times"] = (
        f"SELECT city, CAST(CAST(trip_id AS BIGINT) AS VARCHAR) AS trip_id, arrival_time, departure_time, stop_id, "
        f"stop_sequence FROM ({cleaned['s_stop_times']})"
    )
    common = ",\n".join(f"{name} AS ({cleaned.get(name, body)})" for name, body in BASE.items())
    return f"WITH {common}\n" + _measured(MEASURES)


def _measured(names, measure: bool = True) -> str:
    def one(dataset: str) -> str:
        table = f"s_{dataset}" if dataset in _CLEAN else _TABLES.get(dataset, dataset)
        summed = f", CAST(SUM(CAST({MEASURES[dataset]} AS BIGINT)) AS BIGINT) AS measure" * measure
        return f"SELECT city, '{dataset}' AS dataset, COUNT(*) AS row_count{summed} FROM {table} GROUP BY city"

    return "\nUNION ALL ".join(map(one, names))


def sql() -> dict[str, str]:
    """Complete statements: the common tables, then the query."""
    common = ",\n".join(f"{name} AS ({body})" for name, body in BASE.items())
    statements = {"raw_to_warehouse": _raw_to_warehouse()}
    for name, source in (
        ("one_city_dashboard", "city_dashboard"), ("one_city_top_stops", "top_stops_activity"),
        ("one_city_route_catalog", "route_catalog"),
    ):
        statements[name] = f"WITH {common}\nSELECT * FROM ({FINAL[source]}) WHERE city = 'boston'"
    for name, body in (
        ("scan_clean", _measured(_CLEAN)), ("warehouse_union", _measured(MEASURES)),
        ("dataset_row_counts", _measured(MEASURES, measure=False)),
    ):
        statements[name] = f"WITH {common}\n{body}"
    for name, body in FINAL.items():
        own = body.strip()
        if own.startswith("WITH "):
            statements[name] = f"WITH {common}, {own[5:]}"
        else:
            statements[name] = f"WITH {common}\n{own}"
    return statements
