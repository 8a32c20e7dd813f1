from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows

from transit_engine.operators.latest import latest_vehicle_changelog
from transit_engine.sinks.streams import stream_sink_latest
from transit_engine.sources import streams
from transit_engine.streaming import state_table
from transit_engine.streaming.latest_vehicle import (
    accept_latest,
    accepted_messages,
    keep_latest,
    latest_vehicle_stream,
)

NOON = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def record(seq, minutes, vehicle="v", **more):
    time = None if minutes is None else NOON + timedelta(minutes=minutes)
    return {"city": "b", "vehicle_id": vehicle, "latitude": 1.0, "longitude": 2.0,
            "updated_at": time, "seq": seq, **more}


SCHEMA = (
    "city string, vehicle_id string, latitude double, longitude double, updated_at timestamp, "
    "feed_timestamp timestamp, route_id string, seq long"
)


def land(spark, folder, *records):
    df = spark.createDataFrame(
        [tuple(r.get(n.split()[0]) for n in SCHEMA.split(", ")) for r in records], SCHEMA
    )
    streams.to_messages(df).select("seq", "value").coalesce(1).write.mode("append").parquet(folder)
    return df


def accept(spark, tmp_path, ttl=None):
    messages = streams.stream_raw(spark, path=str(tmp_path / "raw"))
    stream_sink_latest(
        latest_vehicle_stream(messages, ttl), str(tmp_path / "checkpoint"),
        path=str(tmp_path / "latest"), once=True,
    ).awaitTermination()
    return streams.valid_records(spark.read.schema(streams.MESSAGE).parquet(str(tmp_path / "latest")))


def test_late_tied_and_undated_records_across_batches_and_a_restart(spark, tmp_path):
    raw = str(tmp_path / "raw")
    first = land(spark, raw, record(1, 5), record(2, 7), record(3, 6))
    second = land(spark, raw, record(4, 7), record(5, None), record(6, None, "other"))
    assert rows(accept(spark, tmp_path), "seq") == [(1,), (2,), (4,), (6,)]
    third = land(spark, raw, record(7, 6), record(8, 9))
    found = accept(spark, tmp_path)
    assert rows(found, "seq") == [(1,), (2,), (4,), (6,), (8,)]
    whole = first.union(second).union(third)
    assert rows(latest_vehicle_changelog(whole), "seq") == rows(found, "seq")


def test_order_within_a_batch_is_the_arrival_order(spark, tmp_path):
    land(spark, str(tmp_path / "raw"), record(3, 1), record(1, 3), record(2, 2))
    assert rows(accept(spark, tmp_path), "seq") == [(1,)]


def test_state_with_a_life_time_runs(spark, tmp_path):
    land(spark, str(tmp_path / "raw"), record(1, 5), record(2, 4))
    # Otherwise the clock alone keeps starting batches and a bounded run has no end.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        assert rows(accept(spark, tmp_path, ttl=180), "seq") == [(1,)]
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_messages_without_required_fields_are_set_apart(spark):
    messages = spark.createDataFrame(
        [(1, '{"city":"b","vehicle_id":"v","latitude":1,"longitude":2}'), (2, '{"city":"b"}'),
         (3, "no json")], streams.MESSAGE,
    )
    assert rows(streams.valid_records(messages), "seq", "source") == [(1, "unknown")]
    assert rows(streams.rejected_messages(messages), "seq") == [(2,), (3,)]


def test_topic_names():
    assert streams.raw_topic("boston") == "transit.live.raw.boston.vehicles"
    assert streams.latest_topic("chicago") == "transit.live.latest.chicago.vehicles"


def maintain(spark, tmp_path, clock):
    records = streams.stream_latest(spark, path=str(tmp_path / "latest"))
    state_table.maintain_state(
        records, str(tmp_path / "state"), str(tmp_path / "checkpoint"), once=True, clock=clock
    ).awaitTermination()
    return state_table.read_state(spark, str(tmp_path / "state"))


def test_state_takes_the_last_arrival_and_expires(spark, tmp_path):
    latest = str(tmp_path / "latest")
    land(spark, latest, record(1, 5, route_id="1"), record(2, 9, "w"))
    land(spark, latest, record(3, 1, route_id="2"))
    state = maintain(spark, tmp_path, lambda: NOON)
    assert rows(state, "vehicle_id", "seq", "route_id") == [("v", 3, "2"), ("w", 2, None)]
    land(spark, latest, record(4, 2, "x"))
    state = maintain(spark, tmp_path, lambda: NOON + timedelta(seconds=181))
    assert rows(state, "vehicle_id") == [("x",)]


def test_a_batch_that_runs_again_gives_the_same_state(spark, tmp_path):
    folder = str(tmp_path / "state")
    upsert = state_table.live_state_upsert(folder, clock=lambda: NOON)
    batch = streams.valid_records(streams.to_messages(spark.createDataFrame(
        [("b", "v", 1.0, 2.0, NOON, None, "1", 1)], SCHEMA
    )).select("seq", "value"))
    upsert(batch, 0)
    upsert(batch.limit(0), 1)
    upsert(batch, 1)
    upsert(batch, 1)
    assert rows(state_table.read_state(spark, folder), "vehicle_id", "seq") == [("v", 1)]


@pytest.mark.parametrize("version", [5])
def test_incomplete_version_is_not_read(spark, tmp_path, version):
    (tmp_path / f"version={version}").mkdir()
    assert state_table.read_state(spark, str(tmp_path)).count() == 0


def keep(spark, tmp_path, **options):
    folders = [str(tmp_path / name) for name in ("out", "newest", "kept-checkpoint")]
    messages = streams.stream_raw(spark, path=str(tmp_path / "raw"), files_per_trigger=None)
    keep_latest(messages, *folders, once=True, **options).awaitTermination()
    return accepted_messages(spark, folders[0])


def test_batches_keep_the_newest_times_between_them(spark, tmp_path):
    raw = str(tmp_path / "raw")
    land(spark, raw, record(1, 5), record(2, 7), record(3, 6))
    assert rows(keep(spark, tmp_path), "seq") == [(1,), (2,)]
    land(spark, raw, record(4, 7), record(5, None), record(6, None, "other"))
    land(spark, raw, record(7, 6), record(8, 9))
    assert rows(keep(spark, tmp_path), "seq") == [(1,), (2,), (4,), (6,), (8,)]


def test_an_old_record_passes_after_the_life_time(spark, tmp_path):
    raw = str(tmp_path / "raw")
    land(spark, raw, record(1, 5))
    assert rows(keep(spark, tmp_path, ttl_seconds=180, clock=lambda: NOON), "seq") == [(1,)]
    land(spark, raw, record(2, 4))
    early = NOON + timedelta(seconds=100)
    assert rows(keep(spark, tmp_path, ttl_seconds=180, clock=lambda: early), "seq") == [(1,)]
    land(spark, raw, record(3, 4))
    late = NOON + timedelta(seconds=181)
    assert rows(keep(spark, tmp_path, ttl_seconds=180, clock=lambda: late), "seq") == [(1,), (3,)]


def test_a_vehicle_with_most_messages_is_cut_into_blocks(spark, tmp_path):
    """Nine tenths of the messages on one vehicle, all in one trigger, blocks of 50 arrivals."""
    numbers = range(1, 1001)
    records = [record(n, (n * 37) % 101 + n // 10, "hot" if n % 10 else f"v{n % 7}") for n in numbers]
    whole = land(spark, str(tmp_path / "raw"), *records)
    found = keep(spark, tmp_path, block=50)
    assert rows(found, "seq") == rows(latest_vehicle_changelog(whole), "seq")


def test_a_batch_of_accepted_messages_that_runs_again(spark, tmp_path):
    folders = [str(tmp_path / name) for name in ("out", "newest")]
    accept = accept_latest(*folders)
    first = land(spark, str(tmp_path / "a"), record(1, 5))
    second = land(spark, str(tmp_path / "b"), record(2, 4), record(3, 6))
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        accept(streams.to_messages(batch).select("seq", "value"), number)
    assert rows(accepted_messages(spark, folders[0]), "seq") == [(1,), (3,)]
