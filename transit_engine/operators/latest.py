"""Latest state per vehicle over a bounded table of live records.

``order`` names the arrival order, first a dense number (an offset, a sequence), then tie
breakers. Where the result needs order within a vehicle, the work is cut into blocks of
arrivals: inside a block by a window, between blocks through one row per block. A block holds at
most ``block`` consecutive arrivals, whichever vehicles they are from, so no vehicle can fill a
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transit_engine.constants import GAP_FALLBACK_MS, GAP_MAX_MS, GAP_MIN_MS, LIVE_TTL_SECONDS
from transit_engine.functions.text import blank_to_null
from transit_engine.functions.times import event_time_ms

KEY = ["city", "vehicle_id"]
ORDER = ("seq",)
BLOCK = 1_000_000
_BLOCK_KEY = [*KEY, "_block"]


def _in_blocks(records: DataFrame, order: Sequence[str], block: int) -> DataFrame:
    return records.withColumn("_block", F.floor(F.col(order[0]) / block))


def _between_blocks(per_block: DataFrame, carried: Column, name: str) -> DataFrame:
    """A value per block, computed from the earlier blocks of the vehicle; none for the first."""
    return (
        per_block.withColumn(name, carried)
        .where(F.col(name).isNotNull())
        .select(*_BLOCK_KEY, name)
    )


def latest_vehicle_changelog(
    records: DataFrame, order: Sequence[str] = ORDER, block: int = BLOCK
) -> DataFrame:
    """Every record that is accepted when it arrives: none before it for its vehicle is newer.

    Ties are accepted, missing times count as 0. ``ts_ms`` is the time compared.
    """
    timed = records.withColumn(
        "ts_ms", event_time_ms(F.col("updated_at"), F.col("feed_timestamp"))
    )
    return accepted_in_order(timed, order, block)


def accepted_in_order(
    records: DataFrame, order: Sequence[str] = ORDER, block: int = BLOCK
) -> DataFrame:
    """The changelog of records that have their time as ``ts_ms``."""
    timed = _in_blocks(records, order, block)
    per_block = timed.groupBy(*_BLOCK_KEY).agg(F.max("ts_ms").alias("_block_ms"))
    earlier = Window.partitionBy(*KEY).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = _between_blocks(per_block, F.max("_block_ms").over(earlier), "_before_ms")
    upto = Window.partitionBy(*_BLOCK_KEY).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    newest = F.greatest("_upto_ms", F.coalesce("_before_ms", F.lit(0).cast("long")))
    return (
        timed.withColumn("_upto_ms", F.max("ts_ms").over(upto))
        .join(before, _BLOCK_KEY, "left")
        .where(F.col("ts_ms") >= newest)
        .select(*records.columns)
    )


def latest_vehicle_snapshot(records: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """The record each vehicle's changelog ends with: the newest, the later of a tie."""
    timed = records.withColumn(
        "ts_ms", event_time_ms(F.col("updated_at"), F.col("feed_timestamp"))
    )
    last = F.max_by(F.struct(*timed.columns), F.struct("ts_ms", *order))
    return timed.groupBy(*KEY).agg(last.alias("row")).select("row.*")


def vehicle_snapshot_merge(updates: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """The last arrival per vehicle, whatever its time: each update replaces the one before."""
    last = F.max_by(F.struct(*updates.columns), F.struct(*order))
    return updates.groupBy(*KEY).agg(last.alias("row")).select("row.*")


def unexpired(state: DataFrame, now: Column, ttl_seconds: int = LIVE_TTL_SECONDS) -> DataFrame:
    """Records written less than ``ttl_seconds`` before ``now`` (a timestamp column)."""
    age_us = F.unix_micros(now) - F.unix_micros("upserted_at")
    return state.where(age_us < ttl_seconds * 1_000_000)


def list_vehicles(
    state: DataFrame,
    now: Column,
    city: str | None = None,
    route_id: str | None = None,
    ttl_seconds: int = LIVE_TTL_SECONDS,
) -> DataFrame:
    """Unexpired vehicles, by route and then by label (by id where there is none)."""
    live = unexpired(state, now, ttl_seconds)
    if city:
        live = live.where(F.col("city") == city)
    if route_id:
        live = live.where(F.col("route_id") == route_id)
    shown = F.coalesce(blank_to_null(F.col("label")), F.col("vehicle_id"))
    return live.orderBy("city", F.coalesce("route_id", F.lit("")), shown, "vehicle_id")


def live_health(
    state: DataFrame,
    now: Column,
    ttl_seconds: int = LIVE_TTL_SECONDS,
    last_writes: DataFrame | None = None,
) -> DataFrame:
    """Per city: unexpired vehicles, last write and the vehicle it was for.

    ``last_writes`` is the table of last writes kept beside the state; with it they stay known after
    the records have expired and left the state. Without it they are those of the records held.
    """
    age_us = F.unix_micros(now) - F.unix_micros("upserted_at")
    alive = F.count(F.when(age_us < ttl_seconds * 1_000_000, 1)).alias("vehicle_count")
    if last_writes is not None:
        counted = state.groupBy("city").agg(alive)
        return last_writes.join(counted, "city", "left").select(
            "city", F.coalesce("vehicle_count", F.lit(0).cast("long")).alias("vehicle_count"),
            "last_upsert_at", "last_vehicle_id",
        )
    return state.groupBy("city").agg(
        alive,
        F.max("upserted_at").alias("last_upsert_at"),
        # All records of a batch are written at one time: the last to arrive is the last written.
        F.max_by("vehicle_id", F.struct("upserted_at", "seq")).alias("last_vehicle_id"),
    )


def vehicle_update_gap(
    records: DataFrame, order: Sequence[str] = ORDER, block: int = BLOCK
) -> DataFrame:
    """Per update: has the vehicle moved since its last one, and how long to animate it.

    ``gap_ms`` is the time between consecutive arrivals within fixed bounds, or a fixed value
    where a time is missing or does not increase.
    """
    blocks = _in_blocks(records, order, block)
    seen = F.struct("latitude", "longitude", "updated_at")
    per_block = blocks.groupBy(*_BLOCK_KEY).agg(
        F.max_by(seen, F.struct(*order)).alias("_last")
    )
    by_block = Window.partitionBy(*KEY).orderBy("_block")
    before = _between_blocks(per_block, F.lag("_last").over(by_block), "_before")
    in_block = Window.partitionBy(*_BLOCK_KEY).orderBy(*order)
    paired = (
        blocks.withColumn("_lag", F.lag(seen).over(in_block))
        .join(before, _BLOCK_KEY, "left")
        .withColumn("_previous", F.coalesce("_lag", "_before"))
    )
    previous = F.col("_previous")
    step = F.unix_millis("updated_at") - F.unix_millis(previous["updated_at"])
    moved = (previous["latitude"] != F.col("latitude")) | (
        previous["longitude"] != F.col("longitude")
    )
    bounded = F.least(F.greatest(step, F.lit(GAP_MIN_MS)), F.lit(GAP_MAX_MS))
    gap = F.when(step > 0, bounded).otherwise(F.lit(GAP_FALLBACK_MS)).cast("long")
    return paired.select(
        *records.columns, F.coalesce(moved, F.lit(False)).alias("moved"), gap.alias("gap_ms")
    )
