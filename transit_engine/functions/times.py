"""Parsing of feed timestamps. The session time zone is UTC (see ``session.configure``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_local_timestamp(text: Column, formats: Sequence[str], zone: str) -> Column:
    """Local wall-clock text -> UTC instant, first matching format wins, null if none does."""
    attempts = [F.try_to_timestamp(text, F.lit(pattern)) for pattern in formats]
    return F.to_utc_timestamp(F.coalesce(*attempts), zone)


# Date, time of day, fraction and offset: what the cast would take beyond that (a year, a time of
# day alone, which it puts on today) is no feed time.
_ISO = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?"
    r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)?$"
)


def parse_iso_timestamp(text: Column) -> Column:
    """ISO-8601 date and time -> instant (UTC without an offset); anything else -> null."""
    return F.when(text.rlike(_ISO), text).try_cast("timestamp")


def event_time_ms(updated_at: Column, feed_timestamp: Column) -> Column:
    """The later of the two times in epoch milliseconds; a missing time counts as 0."""
    zero = F.lit(0).cast("long")
    return F.greatest(
        F.coalesce(F.unix_millis(updated_at), zero),
        F.coalesce(F.unix_millis(feed_timestamp), zero),
    )
