"""Service calendars: which services run on which dates, and on how many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Position of each weekday flag in dayofweek(): 1 is Sunday.
_FLAGS = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]
_KEY = ["city", "service_id", "service_date"]


def _date(name: str):
    return F.try_to_date(F.col(name).cast("string"), "yyyyMMdd")


def service_calendar_expand(calendar: DataFrame) -> DataFrame:
    """One row per service and date of its period on which the weekday's flag is 1.

    ``sequence`` counts backwards over a reversed period, so those periods are dropped first.
    """
    period = calendar.select(
        "city",
        F.col("service_id").cast("string").alias("service_id"),
        F.array(*[F.col(flag).cast("string").try_cast("int") for flag in _FLAGS]).alias("flags"),
        _date("start_date").alias("first_date"),
        _date("end_date").alias("last_date"),
    ).where(F.col("first_date") <= F.col("last_date"))
    dates = F.sequence(F.col("first_date"), F.col("last_date"))
    # Filter inside the array: dates that do not run are never turned into rows.
    running = F.filter(dates, lambda day: F.element_at(F.col("flags"), F.dayofweek(day)) == 1)
    return period.select("city", "service_id", F.explode(running).alias("service_date"))


def service_exceptions(calendar_dates: DataFrame) -> DataFrame:
    """Dated exceptions, typed; ``exception_type`` 1 adds a date and 2 removes it."""
    return calendar_dates.select(
        "city",
        F.col("service_id").cast("string").alias("service_id"),
        _date("date").alias("service_date"),
        F.col("exception_type").cast("string").try_cast("int").alias("exception_type"),
    ).where(F.col("exception_type").isin(1, 2))


def active_service_dates(
    calendar: DataFrame | None, calendar_dates: DataFrame | None
) -> DataFrame:
    """Dates on which each service runs: weekday dates and additions, minus removals.

    A removal wins over an addition of the same date. One aggregate over the union decides both
    the duplicates and the removals, where a distinct and an anti-join would shuffle twice.
    """
    if calendar is None and calendar_dates is None:
        raise ValueError("give a calendar, its exceptions, or both (either may be empty)")
    parts = []
    if calendar is not None:
        # A calendar is few bytes, which few tasks would read, and each row becomes many dates.
        tasks = 2 * calendar.sparkSession.sparkContext.defaultParallelism
        calendar = calendar.repartition(tasks, "city", "service_id")
        parts.append(service_calendar_expand(calendar).withColumn("removed", F.lit(False)))
    if calendar_dates is not None:
        parts.append(
            service_exceptions(calendar_dates)
            .withColumn("removed", F.col("exception_type") == 2)
            # A removal that names no service removes nothing.
            .where(F.col("service_date").isNotNull())
            .where(F.col("service_id").isNotNull() | ~F.col("removed"))
            .drop("exception_type")
        )
    stacked = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    decided = stacked.groupBy(*_KEY).agg(F.max("removed").alias("removed"))
    return decided.where(~F.col("removed")).select(*_KEY)


def active_service_day_counts(active_dates: DataFrame) -> DataFrame:
    """Number of running dates per service. The dates are unique, so a plain count does."""
    return active_dates.groupBy("city", "service_id").agg(
        F.count("service_date").alias("active_service_days")
    )


def total_feed_days(active_dates: DataFrame) -> DataFrame:
    """Number of distinct running dates per city; a city without any has no row (counts as 1)."""
    return active_dates.groupBy("city").agg(
        F.greatest(F.count_distinct("service_date"), F.lit(1).cast("long")).alias("feed_days")
    )
