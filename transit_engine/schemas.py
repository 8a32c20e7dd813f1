"""Table contracts as DDL strings: raw text, clean, analytics and live records.

Fixed values throughout: names, order and types of columns are what tables are exchanged by.
"""

from __future__ import annotations

# Raw tables are text throughout; a trailing "?" marks a column that a feed may leave out.
RAW_COLUMNS = {
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon", "location_type", "parent_station"],
    "routes": ["route_id", "route_short_name", "route_long_name", "route_type"],
    "trips": [
        "route_id", "service_id", "trip_id", "direction_id", "shape_id", "direction?",
        "wheelchair_accessible", "schd_trip_id?",
    ],
    "stop_times": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"],
    "shapes": ["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"],
    "calendar": [
        "service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday",
        "sunday", "start_date", "end_date",
    ],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "roads": [
        "osm_id", "name", "highway", "start_lat", "start_lon", "end_lat", "end_lon",
        "mid_lat", "mid_lon", "length_m",
    ],
    "pois": ["osm_id", "name", "tag_key", "tag_value", "poi_category", "lat", "lon"],
}

CLEAN = {
    "stops": (
        "city string, stop_id string, stop_name string, stop_lat double, stop_lon double, "
        "location_type int, parent_station string"
    ),
    "routes": (
        "city string, route_id string, route_short_name string, route_long_name string, "
        "route_type int"
    ),
    "trips": (
        "city string, route_id string, service_id string, trip_id string, direction_id int, "
        "shape_id string, direction string, wheelchair_accessible int, schd_trip_id string"
    ),
    "stop_times": (
        "city string, trip_id string, arrival_time string, departure_time string, "
        "stop_id string, stop_sequence int"
    ),
    "shapes": (
        "city string, shape_id string, shape_pt_lat double, shape_pt_lon double, "
        "shape_pt_sequence int"
    ),
    "roads": (
        "city string, osm_id string, name string, highway string, start_lat double, "
        "start_lon double, end_lat double, end_lon double, mid_lat double, mid_lon double, "
        "length_m double"
    ),
    "pois": (
        "city string, osm_id string, name string, tag_key string, tag_value string, "
        "poi_category string, poi_group string, lat double, lon double"
    ),
}

ANALYTICS = {
    "stop_activity": (
        "city string, stop_id string, trip_count long, avg_daily_stop_events double"
    ),
    "stop_activity_enriched": (
        "city string, stop_id string, stop_name string, stop_lat double, stop_lon double, "
        "trip_count long, avg_daily_stop_events double, location_type int, "
        "parent_station string"
    ),
    "route_activity": (
        "city string, route_id string, route_short_name string, route_long_name string, "
        "route_type int, stop_event_count long, distinct_trip_count long, "
        "distinct_stop_count long, avg_daily_stop_events double"
    ),
    "stop_activity_by_route": (
        "city string, route_id string, route_short_name string, route_long_name string, "
        "route_type int, stop_id string, stop_name string, stop_lat double, stop_lon double, "
        "trip_count long, avg_daily_stop_events double"
    ),
    "route_shapes": (
        "city string, route_id string, route_short_name string, route_long_name string, "
        "route_type int, shape_id string, shape_pt_sequence int, shape_pt_lat double, "
        "shape_pt_lon double"
    ),
    "stop_poi_access": (
        "city string, stop_id string, stop_name string, stop_lat double, stop_lon double, "
        "poi_count_within_400m long, food_poi_count_within_400m long, "
        "critical_service_poi_count_within_400m long, park_poi_count_within_400m long, "
        "nearest_school_m double, nearest_hospital_m double, nearest_grocery_m double, "
        "nearest_park_m double, poi_categories string"
    ),
    "busiest_stops_with_poi_context": (
        "city string, stop_id string, stop_name string, stop_lat double, stop_lon double, "
        "trip_count long, avg_daily_stop_events double, poi_count_within_400m long, "
        "food_poi_count_within_400m long, critical_service_poi_count_within_400m long, "
        "park_poi_count_within_400m long, nearest_school_m double, "
        "nearest_hospital_m double, nearest_grocery_m double, nearest_park_m double, "
        "poi_categories string"
    ),
    "route_poi_access": (
        "city string, route_id string, route_short_name string, route_long_name string, "
        "route_type int, stop_count long, total_poi_access long, "
        "avg_poi_access_per_stop double, max_poi_access_at_stop long, "
        "stops_near_hospital long, stops_near_grocery long, stops_near_park long"
    ),
    "transit_road_coverage": (
        "city string, highway string, total_road_segments long, "
        "road_segments_near_transit long, coverage_pct double, total_length_km double, "
        "covered_length_km double"
    ),
}

LIVE_RECORD = (
    "city string, vehicle_id string, route_id string, route_label string, trip_id string, "
    "stop_id string, label string, latitude double, longitude double, bearing double, "
    "speed double, current_status string, occupancy_status string, direction_id int, "
    "route_type int, updated_at timestamp, feed_timestamp timestamp, source string"
)
