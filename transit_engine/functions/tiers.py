"""Bucketing of scores into display tiers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from transit_engine.constants import (
    AVAILABILITY_TIERS,
    LENS_STEPS,
    SMALLEST_ZOOM,
    TRIP_COUNT_TIERS,
    ZOOM_LEVELS,
)


def _first(cuts: Sequence[tuple], met: Callable[[float], Column], otherwise) -> Column:
    """The value of the first cut that is met."""
    return F.coalesce(*[F.when(met(cut), value) for cut, value in cuts], F.lit(otherwise))


def share_of(value: Column, total: Column) -> Column:
    """value / total; 0 where the total is 0 or missing."""
    return F.when(total > 0, F.coalesce(value, F.lit(0)) / total).otherwise(F.lit(0.0))


def availability_tier(ratio: Column) -> Column:
    return _first(AVAILABILITY_TIERS, lambda cut: ratio >= cut, "lower")


def lens_score(lens: str, poi_count: Column, avg_daily: Column, trip_count: Column) -> Column:
    """The score a map view ranks by: places within reach, or daily service."""
    zero = F.lit(0.0)
    if lens == "access":
        return F.coalesce(poi_count.cast("double"), zero)
    return F.coalesce(avg_daily, trip_count.cast("double"), zero)


def lens_score_tier(ratio: Column) -> Column:
    """Four steps, 3 the highest; every cut is exclusive."""
    return _first(LENS_STEPS, lambda cut: ratio > cut, 0)


def trip_count_tier(trip_count: Column) -> Column:
    return _first(TRIP_COUNT_TIERS, lambda cut: trip_count < cut, "very high")


def zoom_bucket(span: Column) -> Column:
    """Map zoom for the larger side, in degrees, of an extent."""
    return _first(ZOOM_LEVELS, lambda cut: span > cut, SMALLEST_ZOOM)
