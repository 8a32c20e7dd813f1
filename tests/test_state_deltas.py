"""The state as deltas over compacted slots: what is written, read, dropped and run again."""

import random
import tracemalloc
from datetime import datetime, timedelta, timezone
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from transit_engine.operators.latest import live_health
from transit_engine.streaming import keyed_deltas, state_table
from transit_engine.streaming.latest_vehicle import LatestOnly, with_payload

NOON = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
RECORD = "city string, vehicle_id string, latitude double, longitude double, seq long"


def batch_of(spark, *records):
    frame = spark.createDataFrame([(c, v, 1.0, 2.0, n) for c, v, n in records], RECORD)
    have = set(frame.columns)
    for field in spark.createDataFrame([], state_table.LIVE_RECORD).schema:
        if field.name not in have:
            frame = frame.withColumn(field.name, F.lit(None).cast(field.dataType))
    return frame


def size(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


@pytest.mark.parametrize("slots", [2])
def test_random_batches_give_the_state_of_a_dictionary(spark, tmp_path, slots):
    """Eight batches, some run again, slots compacted several times, with a life time of 5 batches."""
    rng, folder, expected = random.Random(slots), str(tmp_path / "state"), {}
    for number in range(8):
        now = NOON + timedelta(seconds=10 * number)
        upsert = state_table.live_state_upsert(folder, 50, lambda now=now: now, slots)
        records = [("b", f"v{rng.randrange(30)}", 100 * number + k) for k in range(rng.randrange(9))]
        for _ in range(1 + (number % 5 == 2)):
            upsert(batch_of(spark, *records), number)
        expected |= {vehicle: (seq, now) for _, vehicle, seq in records}
    live = state_table.read_live(spark, folder, now, 50)
    alive = {v: s for v, (s, at) in expected.items() if (now - at).total_seconds() < 50}
    assert rows(live, "vehicle_id", "seq") == sorted(alive.items(), key=repr)
    # Batches that nothing needs any more are gone, so are the bases that were replaced.
    assert len(list((tmp_path / "state/deltas").iterdir())) <= 2 * slots + keyed_deltas.KEPT_VERSIONS
    assert len(list((tmp_path / "state/bases").iterdir())) <= slots + keyed_deltas.KEPT_VERSIONS + 1


def test_a_small_batch_writes_little(spark, tmp_path, monkeypatch):
    """One vehicle in a hundred moves: at most a twentieth of the bytes of the state is written."""
    folder, n = str(tmp_path / "state"), 600_000
    upsert = state_table.live_state_upsert(folder, None, lambda: NOON)

    def moving(every, first_seq):
        ids = spark.range(0, n, every)
        frame = ids.select(
            F.lit("b").alias("city"), F.concat(F.lit("veh-"), "id").alias("vehicle_id"),
            F.rand(1).alias("latitude"), F.rand(2).alias("longitude"), (F.col("id") + first_seq).alias("seq"),
            F.xxhash64("id").cast("string").alias("trip_id"),
        )
        have = set(frame.columns)
        missing = [f for f in spark.createDataFrame([], state_table.LIVE_RECORD).schema if f.name not in have]
        return frame.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})

    upsert(moving(1, 0), 0)
    whole = size(folder)
    monkeypatch.setattr(keyed_deltas, "_drop_old", lambda *_: None)
    # The second of them is late enough to compact a slot too.
    for number in (1, keyed_deltas.SLOTS + 1):
        before = size(folder)
        upsert(moving(100, number * n), number)
        assert size(folder) - before <= 0.05 * whole
    assert (tmp_path / f"state/bases/upto={keyed_deltas.SLOTS + 1}").exists()
    state = state_table.read_state(spark, folder)
    assert state.count() == n and state.where(F.col("seq") > 2 * n).count() == n // 100


def test_listing_opens_live_folders_only(spark, tmp_path):
    """The files of expired folders are made unreadable."""
    folder = str(tmp_path / "state")
    for number, seconds in enumerate((0, 100, 290, 300)):
        now = NOON + timedelta(seconds=seconds)
        state_table.live_state_upsert(folder, 180, lambda now=now: now, 2)(
            batch_of(spark, ("b", f"v{number}", number), ("b", f"w{number}", number)), number
        )
    now = NOON + timedelta(seconds=300)
    dead = [f for f in Path(folder).rglob("*.parquet")
            if "/until=" in str(f) and int(str(f).split("until=")[1].split("/")[0]) <= now.timestamp() - 180]
    assert dead
    for file in dead:
        file.write_bytes(b"not a table")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    live = state_table.read_live(spark, folder, now, 180)
    assert rows(live, "vehicle_id") == [("v2",), ("v3",), ("w2",), ("w3",)]


def test_last_write_stays_when_all_vehicles_are_over(spark, tmp_path):
    folder = str(tmp_path / "state")
    for number, (records, seconds) in enumerate([
        ([("b", "v", 1), ("b", "w", 2), ("c", "x", 3)], 0), ([("b", "v", 4)], 60), ([], 1000), ([], 1001), ([], 1002),
    ]):
        now = NOON + timedelta(seconds=seconds)
        upsert = state_table.live_state_upsert(folder, 180, lambda now=now: now, 2)
        upsert(batch_of(spark, *records), number)
        upsert(batch_of(spark, *records), number)
    state = state_table.read_live(spark, folder, now, 180)
    assert state.count() == 0 and state_table.read_state(spark, folder).count() == 0
    health = live_health(state, F.lit(now), 180, state_table.read_last_writes(spark, folder))
    assert rows(health, "city", "vehicle_count", "last_vehicle_id", F.unix_seconds("last_upsert_at")) == [
        ("b", 0, "v", int(NOON.timestamp()) + 60), ("c", 0, "x", int(NOON.timestamp())),
    ]


def test_a_batch_without_its_marker_does_not_count(spark, tmp_path):
    folder = str(tmp_path / "state")
    for number in range(3):
        state_table.live_state_upsert(folder, None, lambda: NOON, 2)(batch_of(spark, ("b", "v", number)), number)
    (tmp_path / "state/deltas/batch=2/_complete").unlink()
    assert rows(state_table.read_state(spark, folder), "seq") == [(1,)]
    state_table.live_state_upsert(folder, None, lambda: NOON, 2)(batch_of(spark, ("b", "v", 7)), 2)
    assert rows(state_table.read_state(spark, folder), "seq") == [(7,)]
    with pytest.raises(ValueError, match="slots"):
        state_table.live_state_upsert(folder, None, lambda: NOON, 3)(batch_of(spark), 3)


class Value:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_a_vehicle_with_a_million_messages_holds_two_numbers_each():
    """Chunks of 10,000 messages of 200 bytes and more, in no order."""
    processor, n = LatestOnly(payload=False), 1_000_000
    processor.newest = Value()
    rng = np.random.default_rng(1)
    seq = rng.permutation(n)
    times = seq // 3 + rng.integers(0, 50, n)

    def chunks():
        for begin in range(0, n, 10_000):
            part = slice(begin, begin + 10_000)
            yield pd.DataFrame({"city": "b", "vehicle_id": "v", "seq": seq[part], "ts_ms": times[part]})

    tracemalloc.start()
    passed = 0
    for chunk in processor.handleInputRows(("b", "v"), chunks(), None):
        assert len(chunk) <= 10_000
        passed += len(chunk)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    in_order = times[np.argsort(seq)]
    assert passed == (in_order >= np.maximum.accumulate(in_order)).sum()
    assert peak < 120e6 and processor.newest.value == (in_order.max(),)


def test_messages_are_put_back(spark):
    value = '{"city":"b","vehicle_id":"v","updated_at":"2024-01-01T00:00:00Z"}'
    messages = spark.createDataFrame([(1, value), (2, value), (2, value)], "seq long, value string")
    accepted = spark.createDataFrame([("b", "v", 2, 5)], "city string, vehicle_id string, seq long, ts_ms long")
    assert rows(with_payload(accepted, messages)) == [("b", "v", 2, 5, value)]


def test_a_table_of_one_slot(spark, tmp_path):
    folder = str(tmp_path / "state")
    for number in range(4):
        state_table.live_state_upsert(folder, None, lambda: NOON, 1)(batch_of(spark, ("b", f"v{number % 3}", number)), number)
    assert rows(state_table.read_state(spark, folder), "vehicle_id", "seq") == [("v0", 3), ("v1", 1), ("v2", 2)]
