"""Schedule and map files, and the clean Parquet tables.

Raw files are read as text by header name, without inference: an inferred ``007`` would become
7 and an inferred ``05:30:00`` a timestamp. Every city has its own files with its own column
order, so each is read by itself and the reads are stacked.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from transit_engine.schemas import CLEAN, RAW_COLUMNS

GTFS_TABLES = ["stops", "routes", "trips", "stop_times", "shapes"]


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def _read_text_table(spark: SparkSession, path: str, city: str) -> DataFrame:
    return spark.read.option("header", True).csv(path).withColumn("city", F.lit(city))


def _stack(frames: list[DataFrame]) -> DataFrame:
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def _empty(spark: SparkSession, table: str) -> DataFrame:
    names = [name.rstrip("?") for name in RAW_COLUMNS[table]]
    return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in [*names, "city"]))


def scan_gtfs(spark: SparkSession, folders: Mapping[str, str], table: str) -> DataFrame:
    """One schedule table of every city; ``folders`` maps a city to its folder."""
    return _stack([
        _read_text_table(spark, f"{folder}/{table}.txt", city) for city, folder in folders.items()
    ])


def scan_calendar(spark: SparkSession, folders: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """``calendar`` and ``calendar_dates``; a file that a city lacks adds no rows."""

    def optional(table: str) -> DataFrame:
        found = [
            _read_text_table(spark, f"{folder}/{table}.txt", city)
            for city, folder in folders.items()
            if path_exists(spark, f"{folder}/{table}.txt")
        ]
        return _stack([_empty(spark, table), *found])

    return optional("calendar"), optional("calendar_dates")


def scan_osm(spark: SparkSession, folders: Mapping[str, str], table: str) -> DataFrame:
    """``roads`` or ``pois`` of every city.

    An extract without any place is an empty file, without header line; it adds no rows. A file
    with another header is an error, not a city without places.
    """
    frames = [_empty(spark, table)]
    for city, folder in folders.items():
        path = f"{folder}/{table}.csv"
        frame = _read_text_table(spark, path, city)
        if "osm_id" in frame.columns:
            frames.append(frame)
        elif not spark.read.text(path).where(F.trim("value") != "").isEmpty():
            raise ValueError(f"no osm_id in the header of {path}: {frame.columns}")
    return _stack(frames)


def read_dataset(spark: SparkSession, root: str, dataset: str, schema: str) -> DataFrame:
    """A dataset partitioned by city, columns in the order of its contract.

    A city filter prunes the other cities' folders.
    """
    names = StructType.fromDDL(schema).names
    return spark.read.schema(schema).parquet(f"{root}/{dataset}").select(*names)


def scan_clean(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A clean table of all cities."""
    return read_dataset(spark, root, table, CLEAN[table])
