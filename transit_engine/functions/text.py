"""Text columns: blanks, lookups and the display texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transit_engine.constants import (
    AMENITY_GROUP_LABELS,
    CITY_BUS_STATUS,
    DAILY_NEEDS,
    NO_DAILY_NEEDS,
    OTHER_CITY_BUS_STATUS,
    OTHER_STATUS,
    POI_CATEGORY_LABELS,
    ROUTE_TYPE_LABELS,
    VEHICLE_STATUS,
)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def lookup(values: dict, key: Column) -> Column:
    """A constant dictionary as a map literal; null where the key is absent."""
    pairs = [F.lit(item) for pair in values.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def joined(separator: str, *parts: Column) -> Column:
    """The non-blank parts joined, or null if there are none."""
    return blank_to_null(F.concat_ws(separator, *[blank_to_null(part) for part in parts]))


def route_type_label(route_type: Column) -> Column:
    return F.coalesce(lookup(ROUTE_TYPE_LABELS, route_type), F.lit("Transit"))


def route_label(short_name: Column, long_name: Column, route_id: Column) -> Column:
    return F.coalesce(
        joined(" — ", short_name, long_name), blank_to_null(route_id), F.lit("Unknown route")
    )


def amenity_group_label(group: Column) -> Column:
    return F.coalesce(
        lookup(AMENITY_GROUP_LABELS, group), blank_to_null(group), F.lit("Other amenities")
    )


def split_categories(categories: Column) -> Column:
    """The category list text as an array: trimmed, without blanks."""
    parts = F.transform(F.split(F.coalesce(categories, F.lit("")), ","), lambda p: F.trim(p))
    return F.filter(parts, lambda part: part != "")


def category_labels(categories: Column, limit: int = 4) -> Column:
    """The labels of the first ``limit`` categories."""
    labels = F.transform(
        F.slice(split_categories(categories), 1, limit),
        lambda part: F.coalesce(
            lookup(POI_CATEGORY_LABELS, part), F.replace(part, F.lit("_"), F.lit(" "))
        ),
    )
    return labels


def daily_needs_text(food: Column, critical: Column, park: Column) -> Column:
    def phrase(count: Column, noun: str) -> Column:
        return F.when(count > 0, F.concat(F.format_number(count, 0), F.lit(f" {noun}")))

    phrases = [phrase(count, noun) for count, noun in zip((food, critical, park), DAILY_NEEDS)]
    return F.coalesce(joined(" · ", *phrases), F.lit(NO_DAILY_NEEDS))


def vehicle_status_text(status: Column, city: Column, route_type: Column) -> Column:
    def told(texts: dict[str, str], other: str) -> Column:
        return F.coalesce(*[F.when(status == name, text) for name, text in texts.items()], F.lit(other))

    city_bus = (city == "chicago") & (route_type == 3)
    return F.when(city_bus, told(VEHICLE_STATUS | CITY_BUS_STATUS, OTHER_CITY_BUS_STATUS)).otherwise(
        told(VEHICLE_STATUS, OTHER_STATUS)
    )


def stop_display_label(stop_name: Column, instances: Column) -> Column:
    return F.when(
        instances > 1, F.concat(stop_name, F.format_string(" (%d platforms)", instances))
    ).otherwise(stop_name)
