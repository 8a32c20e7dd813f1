"""What the operators of this subpackage share: tables, saved steps, size-checked broadcasts."""

from __future__ import annotations

import math

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_engine.session import scratch_path

# White space of all word and text definitions here, as a Java pattern.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# The most that any broadcast here may hold; what is sent has a bound of its own besides.
MAX_BROADCAST_BYTES = 256 << 20
# Narrow rows of a written step that are worth a file of their own.
ROWS_PER_FILE = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a step below the folder all executors share and read it back.

    Cuts lineage, so that a lost executor costs no more than the tasks it ran, and lets later
    plans see the true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_narrow(df: DataFrame, name: str, at_most: int) -> DataFrame:
    """As ``saved``, for ``at_most`` narrow rows: as many files as these need.

    Many steps over few rows would write a file per shuffle partition each; local file systems start
    a process or more per file.
    """
    return saved(df.coalesce(max(1, math.ceil(at_most / ROWS_PER_FILE))), name)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def broadcast_bounded(spark: SparkSession, value, n_bytes: int) -> Broadcast:
    """Broadcast a model whose size was checked."""
    if n_bytes > MAX_BROADCAST_BYTES:
        raise ValueError(f"{n_bytes} bytes are too many to broadcast")
    return spark.sparkContext.broadcast(value)
