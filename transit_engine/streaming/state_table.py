"""The served state: one row per vehicle, kept as deltas over compacted slots by ``foreachBatch``.

A batch writes the vehicles it names, one slot of the others, and a small table with the last write
of each city. A batch that runs again overwrites its own, so a restart gives the same table. Records
expire some time after their last write, which also bounds the table; the last writes stay.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transit_engine.constants import LIVE_TTL_SECONDS
from transit_engine.operators.latest import KEY, unexpired
from transit_engine.schemas import LIVE_RECORD
from transit_engine.streaming.keyed_deltas import (
    KEPT_VERSIONS,
    SLOTS,
    alive_since,
    compact,
    complete,
    drop_folder,
    mark_complete,
    read_rows,
    write_delta,
)

STATE = f"{LIVE_RECORD}, seq long, upserted_at timestamp"
LAST_WRITES = "city string, last_upsert_at timestamp, last_vehicle_id string"


def newest_arrivals(arrived: DataFrame) -> DataFrame:
    """One row per vehicle of a batch: the last to arrive."""
    last = F.max_by(F.struct(*arrived.columns), "seq")
    return arrived.groupBy(*KEY).agg(last.alias("row")).select("row.*")


def merge_last_writes(known: DataFrame, arrived: DataFrame) -> DataFrame:
    """Per city the time of the last write and the vehicle it was for, whether expired or not."""
    # All records of a batch are written at one time: the last to arrive is the last written.
    fresh = arrived.groupBy("city").agg(
        F.max("upserted_at").alias("last_upsert_at"), F.max_by("vehicle_id", "seq").alias("last_vehicle_id")
    )
    stacked = known.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    last = F.max_by(F.struct(*known.columns), F.struct("last_upsert_at", "_new"))
    return stacked.groupBy("city").agg(last.alias("row")).select("row.*")


def live_state_upsert(
    folder: str,
    ttl_seconds: int | None = LIVE_TTL_SECONDS,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    slots: int = SLOTS,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds each batch of records to the state."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = F.lit(clock())
        arrived = newest_arrivals(batch.withColumn("upserted_at", now))
        rows = write_delta(arrived, folder, batch_id, KEY, "upserted_at", ttl_seconds, slots)
        known = read_last_writes(spark, folder, before=batch_id)
        write_version(merge_last_writes(known, rows), f"{folder}/last_writes", batch_id)
        compact(spark, folder, batch_id, STATE, KEY, "upserted_at", ttl_seconds, now, slots)

    return upsert


def read_state(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The state after all batches (or those ``before`` one), without what had expired by then; an
    empty table where there is none."""
    since = alive_since(spark, folder, before)
    if since is None:
        return read_rows(spark, folder, STATE, KEY, before)
    rows = read_rows(spark, folder, STATE, KEY, before, alive_after=since // 1_000_000)
    return rows.where(F.unix_micros("upserted_at") > since)


def read_live(
    spark: SparkSession, folder: str, now: datetime, ttl_seconds: int = LIVE_TTL_SECONDS
) -> DataFrame:
    """The records that are not expired at ``now``; folders of older ones are not opened."""
    alive_after = int(now.timestamp()) - ttl_seconds
    state = read_rows(spark, folder, STATE, KEY, alive_after=alive_after)
    return unexpired(state, F.lit(now), ttl_seconds)


def read_last_writes(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The last write of each city that ever had one."""
    versions = complete(spark, f"{folder}/last_writes", "version")
    versions = [v for v in versions if before is None or v < before]
    if not versions:
        return spark.createDataFrame([], LAST_WRITES)
    return spark.read.schema(LAST_WRITES).parquet(f"{folder}/last_writes/version={versions[-1]}")


def write_version(df: DataFrame, folder: str, version: int) -> None:
    """Write one version of a small table, and drop versions that are no longer needed."""
    spark = df.sparkSession
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version}")
    mark_complete(spark, f"{folder}/version={version}")
    for old in complete(spark, folder, "version"):
        if old <= version - KEPT_VERSIONS:
            drop_folder(spark, f"{folder}/version={old}")


def maintain_state(
    records: DataFrame, folder: str, checkpoint: str, once: bool = False, **options
) -> StreamingQuery:
    """Start the query that keeps the state table up to date with a stream of records."""
    writer = records.writeStream.foreachBatch(live_state_upsert(folder, **options)).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
