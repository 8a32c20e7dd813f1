"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transit_engine.constants import EARTH_RADIUS_M


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres. The root is capped at 1 so rounding never gives NaN."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.least(F.sqrt(chord), F.lit(1.0)))


def within_box(lat1: Column, lon1: Column, lat2: Column, lon2: Column, box) -> Column:
    """Strictly inside a latitude/longitude box given by its two half-widths in degrees."""
    return (F.abs(lat1 - lat2) < F.lit(float(box[0]))) & (F.abs(lon1 - lon2) < F.lit(float(box[1])))


def finite(value: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    number = value.cast("double")
    return (
        number.isNotNull()
        & ~F.isnan(number)
        & (F.abs(number) < F.lit(float("inf")))
    )
