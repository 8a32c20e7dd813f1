"""Batch sinks: partitioned datasets, the all-cities warehouse tables, row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from transit_engine.sources.files import path_exists


def write_dataset(
    df: DataFrame, root: str, dataset: str, cities: Sequence[str] = ()
) -> dict[str, int]:
    """Write ``root/dataset`` by city and return its row count.

    Only the cities that ``df`` has are replaced, so a rerun of one city leaves the others.
    ``cities`` are those the run is for: one of them that has become empty loses its old rows. The
    counts are observed during the write instead of running the plan twice.
    """
    counted = Observation(dataset)
    per_city = [
        F.count(F.when(F.col("city") == city, 1)).alias(f"rows_{i}") for i, city in enumerate(cities)
    ]
    (
        df.observe(counted, F.count(F.lit(1)).alias("row_count"), *per_city)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("city")
        .parquet(f"{root}/{dataset}")
    )
    counts = counted.get
    for i, city in enumerate(cities):
        if not counts[f"rows_{i}"]:
            remove_folder(df.sparkSession, f"{root}/{dataset}/city={city}")
    return {dataset: int(counts["row_count"])}


def remove_folder(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def city_folders(
    spark: SparkSession, folders: Mapping[str, str], dataset: str
) -> list[DataFrame]:
    """The dataset of each city that has it, from one folder per city."""
    return [
        spark.read.parquet(f"{folder}/{dataset}")
        for folder in folders.values()
        if path_exists(spark, f"{folder}/{dataset}")
    ]


def warehouse_union(parts: list[DataFrame]) -> DataFrame:
    """The cities' parts of one dataset stacked, with upper-case column names."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.toDF(*[name.upper() for name in stacked.columns])


def load_warehouse(df: DataFrame, table: str, writer_format: str = "parquet", **options) -> None:
    """Full refresh of a warehouse table (``writer_format="jdbc"`` with its options, or a table)."""
    writer = df.write.mode("overwrite").format(writer_format).options(**options)
    if writer_format == "jdbc":
        writer.option("dbtable", table).save()
    else:
        writer.saveAsTable(table)


def dataset_row_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """(city, dataset, row_count) over any number of datasets, as one plan."""
    counts = [
        df.groupBy("city").agg(F.count(F.lit(1)).alias("row_count")).select(
            "city", F.lit(name).alias("dataset"), "row_count"
        )
        for name, df in datasets.items()
    ]
    stacked = counts[0]
    for count in counts[1:]:
        stacked = stacked.unionByName(count)
    return stacked
