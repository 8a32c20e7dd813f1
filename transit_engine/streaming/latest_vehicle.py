"""The keyed "latest only" stream: a changelog of accepted records.

Two forms. ``keep_latest`` works on whole micro-batches with DataFrame operations: the batch is cut
into blocks of arrivals, so that a vehicle with most of the messages fills no task, and a small
table has the newest time of each vehicle between batches. ``latest_vehicle_stream`` keeps keyed
state and gives a stream. Of one vehicle's part of a batch it holds two numbers per message in memory,
and the messages too where they are to come along; else they are put back by a join.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from transit_engine.functions.times import event_time_ms, parse_iso_timestamp
from transit_engine.operators.latest import BLOCK, KEY, accepted_in_order
from transit_engine.streaming.keyed_deltas import SLOTS, compact, read_rows, write_delta

ACCEPTED_TIMES = "city string, vehicle_id string, seq long, ts_ms long"
ACCEPTED = f"{ACCEPTED_TIMES}, value string"
AT_ONCE = 10_000
_STATE = T.StructType([T.StructField("newest_ms", T.LongType())])
_TIMES = "city string, vehicle_id string, updated_at string, feed_timestamp string"


class LatestOnly(StatefulProcessor):
    """State per vehicle: the newest accepted time. A record passes if it is not older.

    Without payload, two numbers per message of a vehicle's part of a batch are held, and what
    passes goes on in chunks. With payload, so are the messages that are not older than the state.
    """

    def __init__(self, ttl_seconds: int | None = None, payload: bool = True):
        self.ttl_seconds, self.payload = ttl_seconds, payload

    def init(self, handle) -> None:
        ttl_ms = self.ttl_seconds * 1000 if self.ttl_seconds else None
        self.newest = handle.getValueState("newest_ms", _STATE, ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        stored = self.newest.get()
        floor = np.iinfo(np.int64).min if stored is None else stored[0]
        held = []
        for chunk in rows:
            chunk = chunk[chunk["ts_ms"] >= floor]
            held.append([chunk[name].to_numpy() for name in ("seq", "ts_ms", *["value"] * self.payload)])
        columns = [np.concatenate(column) for column in zip(*held)]
        order = np.argsort(columns[0], kind="stable")
        times = columns[1][order]
        newest = np.maximum.accumulate(times)
        passed = order[times >= newest]
        if len(passed):
            self.newest.update((int(newest[-1]),))
        for begin in range(0, len(passed), AT_ONCE):
            part = [column[passed[begin : begin + AT_ONCE]] for column in columns]
            named = zip(("seq", "ts_ms", "value"), part)
            yield pd.DataFrame({"city": key[0], "vehicle_id": key[1], **dict(named)})

    def close(self) -> None:
        pass


def timed_messages(messages: DataFrame) -> DataFrame:
    """Messages (seq, value) with their key and the time that is compared."""
    head = F.from_json("value", _TIMES).alias("head")
    return messages.select("seq", "value", head).select(
        "head.city", "head.vehicle_id", "seq",
        event_time_ms(
            parse_iso_timestamp(F.col("head.updated_at")),
            parse_iso_timestamp(F.col("head.feed_timestamp")),
        ).alias("ts_ms"),
        "value",
    )


NEWEST = "city string, vehicle_id string, newest_ms long, accepted_at timestamp"


def accept_latest(
    out: str,
    state: str,
    ttl_seconds: int | None = None,
    block: int = BLOCK,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    slots: int = SLOTS,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch's accepted messages below ``out``.

    What was accepted before counts as one arrival ahead of the batch. Times are forgotten
    ``ttl_seconds`` after a vehicle's last accepted message; after that an older one passes again.
    A batch that runs again overwrites what it wrote.
    """

    def accept(batch: DataFrame, batch_id: int) -> None:
        spark, now = batch.sparkSession, F.lit(clock())
        known = read_rows(spark, state, NEWEST, KEY, before=batch_id)
        if ttl_seconds is not None:
            age_us = F.unix_micros(now) - F.unix_micros("accepted_at")
            known = known.where(age_us < ttl_seconds * 1_000_000)
        before = known.select(
            *KEY, F.lit(-1).cast("long").alias("seq"), F.col("newest_ms").alias("ts_ms"),
            F.lit(None).cast("string").alias("value"),
        )
        arrived = timed_messages(batch).select(*before.columns)
        accepted = accepted_in_order(before.unionByName(arrived), block=block).where("seq >= 0")
        target = f"{out}/batch={batch_id}"
        accepted.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
        written = spark.read.schema(ACCEPTED).parquet(target)
        # An accepted time is never below the one known, so the newest row of a vehicle holds.
        latest = written.groupBy(*KEY).agg(F.max("ts_ms").alias("newest_ms")).withColumn("accepted_at", now)
        write_delta(latest, state, batch_id, KEY, "accepted_at", ttl_seconds, slots)
        compact(spark, state, batch_id, NEWEST, KEY, "accepted_at", ttl_seconds, now, slots)

    return accept


def keep_latest(
    messages: DataFrame, out: str, state: str, checkpoint: str, once: bool = False, **options
) -> StreamingQuery:
    """Start the query that writes the accepted messages of a stream below ``out``."""
    writer = messages.writeStream.foreachBatch(accept_latest(out, state, **options)).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def accepted_messages(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(ACCEPTED).parquet(f"{out}/batch=*")


def latest_vehicle_stream(
    messages: DataFrame, ttl_seconds: int | None = None, payload: bool = True
) -> DataFrame:
    """Messages (seq, value) -> the accepted ones, whole, with their key and compared time.

    Only the key and the two times are parsed. Without ``payload`` only they go through the keyed
    state, which a vehicle with very many messages in one trigger needs; ``with_payload`` puts the
    messages back. There is no watermark: a late record is judged against its own vehicle only.
    State is kept for good, or for ``ttl_seconds`` after the last accepted record; after that an
    older one passes again. With a life time, a run that should end by itself (``availableNow``)
    needs ``spark.sql.streaming.noDataMicroBatches.enabled=false``.
    """
    timed = timed_messages(messages)
    return (timed if payload else timed.drop("value")).groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=LatestOnly(ttl_seconds, payload),
        outputStructType=ACCEPTED if payload else ACCEPTED_TIMES,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_seconds else "None",
    )


def with_payload(accepted: DataFrame, messages: DataFrame) -> DataFrame:
    """Accepted arrivals (a table, such as what a micro-batch wrote) with their messages.

    The join is on the arrival and the vehicle, so it is spread however many messages one vehicle
    has; a message that is there twice counts once.
    """
    keyed = timed_messages(messages).select("seq", *KEY, "value")
    once = keyed.groupBy("seq", *KEY).agg(F.first("value").alias("value"))
    return accepted.join(once, ["seq", *KEY]).select(
        *[name.split()[0] for name in ACCEPTED.split(", ")]
    )
