"""Every dataset of a run into the warehouse: clean tables and analytics of all cities, or the ten
city-less tables of a single city."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from transit_engine.schemas import ANALYTICS, CLEAN
from transit_engine.sinks.datasets import load_warehouse, warehouse_union
from transit_engine.sources.files import path_exists, read_dataset

DATASETS = {**CLEAN, **ANALYTICS}

# The warehouse tables of the city-less datasets.
SINGLE_CITY_TABLES = {
    "stops": "CLEAN_GTFS_STOPS",
    "routes": "CLEAN_GTFS_ROUTES",
    "trips": "CLEAN_GTFS_TRIPS",
    "stop_times": "CLEAN_GTFS_STOP_TIMES",
    "shapes": "CLEAN_GTFS_SHAPES",
    "stop_activity": "ANALYTICS_STOP_ACTIVITY",
    "stop_activity_enriched": "ANALYTICS_STOP_ACTIVITY_ENRICHED",
    "route_activity": "ANALYTICS_ROUTE_ACTIVITY",
    "stop_activity_by_route": "ANALYTICS_STOP_ACTIVITY_BY_ROUTE",
    "route_shapes": "ANALYTICS_ROUTE_SHAPES",
}


def load_datasets(
    spark: SparkSession,
    clean_root: str,
    analytics_root: str,
    cities: Sequence[str],
    prefix: str = "",
    **options,
) -> dict[str, str]:
    """Full refresh of one warehouse table per dataset; returns the table of each.

    A city is one part; only its folders are read, and a city without the dataset is left out.
    """
    tables = {}
    for dataset, schema in DATASETS.items():
        root = clean_root if dataset in CLEAN else analytics_root
        parts = [
            read_dataset(spark, root, dataset, schema).where(f"city = '{city}'")
            for city in cities if path_exists(spark, f"{root}/{dataset}/city={city}")
        ]
        if parts:
            tables[dataset] = f"{prefix}{dataset}"
            load_warehouse(warehouse_union(parts), tables[dataset], **options)
    return tables


def load_single_city(
    spark: SparkSession, clean_root: str, analytics_root: str, prefix: str = "", **options
) -> dict[str, str]:
    """Full refresh of the ten tables of a single city, from folders that are not cut by city.

    Returns the table of each dataset; one whose folder is missing is left out.
    """
    tables = {}
    for dataset, table in SINGLE_CITY_TABLES.items():
        folder = f"{clean_root if dataset in CLEAN else analytics_root}/{dataset}"
        if path_exists(spark, folder):
            tables[dataset] = f"{prefix}{table}"
            load_warehouse(warehouse_union([spark.read.parquet(folder)]), tables[dataset], **options)
    return tables
