from conftest import rows
from pyspark.sql import functions as F

from transit_engine.operators import cleaning, service_calendar
from transit_engine.sources.files import scan_calendar, scan_gtfs, scan_osm


def test_stops_from_files_keep_text_and_drop_bad_rows(spark, tmp_path):
    (tmp_path / "stops.txt").write_text(
        "stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station\n"
        "007, Main ,42.1,-71.1,0,\n"
        "007,Annex,42.1,-71.1,0,\n"
        "8,,42.1,-71.1,0,\n"
        "9,Bad,north,-71.1,0,\n"
        "10,Odd type,42.1,-71.1,x, 007 \n"
    )
    clean = cleaning.clean_stops(scan_gtfs(spark, {"boston": str(tmp_path)}, "stops"))
    assert rows(clean, "stop_id", "stop_name", "location_type", "parent_station") == [
        ("007", "Annex", 0, None), ("10", "Odd type", None, "007"),
    ]


def test_times_past_midnight_stay_text_and_repeats_stay(spark, tmp_path):
    line = "01,25:10:00,05:30:00,7,1\n"
    (tmp_path / "stop_times.txt").write_text(
        "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n" + line + line
        + "01,1:00:00,1:00:00,7,x\n"
    )
    raw = scan_gtfs(spark, {"boston": str(tmp_path)}, "stop_times")
    assert rows(cleaning.clean_stop_times(raw)) == [
        ("boston", "01", "25:10:00", "05:30:00", "7", 1)
    ] * 2


def test_cities_may_order_and_omit_columns_differently(spark, tmp_path):
    for city, text in {
        "boston": "route_id,service_id,trip_id,direction_id,shape_id,wheelchair_accessible\n"
        "r,s,t,0,h,1\n",
        "chicago": "trip_id,route_id,service_id,schd_trip_id,direction_id,direction,shape_id,"
        "wheelchair_accessible\nt,r,,77,1,North,,2\n",
    }.items():
        (tmp_path / city).mkdir()
        (tmp_path / city / "trips.txt").write_text(text)
    folders = {city: str(tmp_path / city) for city in ("boston", "chicago")}
    clean = cleaning.clean_trips(scan_gtfs(spark, folders, "trips"))
    assert rows(clean) == [
        ("boston", "r", "s", "t", 0, "h", None, 1, None),
        ("chicago", "r", None, "t", 1, None, "North", 2, "77"),
    ]


def test_optional_column_of_a_table_that_lacks_it(spark):
    df = spark.createDataFrame([(" a ",)], "direction string")
    picked = df.select(
        cleaning.optional_string_column(df, "direction"),
        cleaning.optional_string_column(df, "schd_trip_id"),
    )
    assert rows(picked) == [("a", None)]
    assert picked.dtypes == [("direction", "string"), ("schd_trip_id", "string")]


def test_roads_without_length_stay_and_smallest_of_an_id_is_kept(spark):
    columns = (
        "city string, osm_id string, name string, highway string, start_lat string, "
        "start_lon string, end_lat string, end_lon string, mid_lat string, mid_lon string, "
        "length_m string"
    )
    place = ("1", "2", "3", "4", "2", "3")
    raw = spark.createDataFrame(
        [
            ("b", "1", "B", "primary", *place, "5"), ("b", "1", "A", "primary", *place, None),
            ("b", "2", "C", "footway", *place, "5"), ("b", "1", "0", "path", *place, "5"),
        ],
        columns,
    )
    assert rows(cleaning.clean_roads(raw), "osm_id", "name", "length_m") == [("1", "A", None)]


def test_empty_place_extract_gives_a_typed_empty_table(spark, tmp_path):
    (tmp_path / "pois.csv").write_text("\n")
    clean = cleaning.clean_pois(scan_osm(spark, {"boston": str(tmp_path)}, "pois"))
    assert clean.count() == 0
    assert dict(clean.dtypes)["lat"] == "double"


def test_first_accepted_tag_counts(spark):
    features = spark.createDataFrame(
        [("b", 1, "x", "bench", "supermarket", "park", 1.0, 2.0),
         ("b", 2, "y", "cafe", "supermarket", None, 1.0, 2.0),
         ("b", 3, "z", "bench", None, "pitch", 1.0, 2.0)],
        "city string, osm_id int, name string, amenity string, shop string, leisure string, "
        "lat double, lon double",
    )
    assert rows(cleaning.classify_pois(features), "osm_id", "tag_key", "poi_category") == [
        ("1", "shop", "supermarket"), ("2", "amenity", "cafe"),
    ]


def _calendar(spark, *lines):
    days = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    columns = ", ".join(f"{n} string" for n in ["city", "service_id", *days, "start_date", "end_date"])
    return spark.createDataFrame(
        [("b", service, *flags, start, end) for service, flags, start, end in lines], columns
    )


def _exceptions(spark, *lines):
    return spark.createDataFrame(
        [("b", *line) for line in lines],
        "city string, service_id string, date string, exception_type string",
    )


def test_weekdays_and_reversed_periods(spark):
    calendar = _calendar(
        spark, ("sun", "0000001", "20240101", "20240114"), ("mon", "1000000", "20240101", "20240107"),
        ("back", "1111111", "20240105", "20240101"),
    )
    expanded = service_calendar.service_calendar_expand(calendar)
    assert rows(expanded.select("service_id", F.col("service_date").cast("string"))) == [
        ("mon", "2024-01-01"), ("sun", "2024-01-07"), ("sun", "2024-01-14"),
    ]


def test_removal_wins_and_additions_are_distinct(spark):
    calendar = _calendar(spark, ("a", "1000000", "20240101", "20240108"))
    exceptions = _exceptions(
        spark, ("a", "20240101", "1"), ("a", "20240101", "2"), ("a", "20240103", "1"),
        ("a", "20240103", "1"), ("new", "20240104", "1"),
    )
    dates = service_calendar.active_service_dates(calendar, exceptions)
    assert rows(dates.select("service_id", F.col("service_date").cast("string"))) == [
        ("a", "2024-01-03"), ("a", "2024-01-08"), ("new", "2024-01-04"),
    ]
    assert rows(service_calendar.total_feed_days(dates)) == [("b", 3)]
    only = service_calendar.active_service_dates(None, exceptions)
    assert only.count() == 2


def test_missing_calendar_files_are_empty(spark, tmp_path):
    (tmp_path / "calendar_dates.txt").write_text("service_id,date,exception_type\na,20240101,1\n")
    dates = service_calendar.active_service_dates(*scan_calendar(spark, {"b": str(tmp_path)}))
    assert dates.count() == 1
