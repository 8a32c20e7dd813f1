"""Ranks and running sums over groups of any size.

A window over a city puts all of its rows into one task. Here the rows are put in order by range:
each task gets a stretch of the order, whichever groups that holds, and counts and sums the part of
each group in it. One row per stretch, for the group that goes on from the one before, carries its
offsets and is sent to all tasks. A large group is so spread over many tasks and a task may hold many
groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transit_engine.session import scratch_path


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``"-name"`` sorts downwards, ``"name"`` upwards; nulls come last either way."""
    return [
        F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in order
    ]


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """A step written below the shared folder and read back, so that it is worked out once."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def freed(df: DataFrame, name: str) -> DataFrame:
    """As ``written``, for large steps: the files of its shuffles go when it is done.

    Spark else keeps them as long as the driver's memory isn't tidied up, so that those of all steps of
    a query are on the disks at once. The step's own plan runs only here, so nothing reads them again.
    """
    spark = df.sparkSession
    before = spark.conf.get(_FREE)
    spark.conf.set(_FREE, "true")
    try:
        return written(df, name)
    finally:
        spark.conf.set(_FREE, before)


def in_order(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    rank: str,
    sums: Mapping[str, Column] | None = None,
    stretches: int | None = None,
) -> DataFrame:
    """The rows with their ``rank`` (from 1) within their group and running sums up to them.

    ``order`` should end with a unique key, else ranks of equal rows are drawn anew by each run.
    The stretches are written first: where they begin is drawn from a sample and has to stay.
    """
    sums = dict(sums or {})
    keys = [*[F.col(name).asc() for name in by], *sort_columns(order)]
    dealt = df.repartitionByRange(stretches, *keys) if stretches else df.repartitionByRange(*keys)
    cut = freed(
        dealt.sortWithinPartitions(*keys).select(
            "*", *[value.alias(f"_{name}") for name, value in sums.items()],
            F.spark_partition_id().alias("_stretch_part"),
        ),
        "stretches",
    )
    group = [*by, "_stretch_part"]
    totals = cut.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_{name}").alias(f"_total_{name}") for name in sums]
    )
    earlier = Window.partitionBy(*by).orderBy("_stretch_part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the group that a stretch begins with can have rows before it: one row per stretch at most.
    offsets = freed(
        totals.select(
            *[F.col(name).alias(f"_of_{name}") for name in group], F.sum("_rows").over(earlier).alias("_before"),
            *[F.sum(f"_total_{name}").over(earlier).alias(f"_before_{name}") for name in sums],
        ).where("_before > 0"),
        "offsets",
    )
    within = Window.partitionBy(*group).orderBy(*sort_columns(order))
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cut.select(
        "*", F.row_number().over(within).alias("_place"),
        *[F.sum(f"_{name}").over(upto).alias(f"_upto_{name}") for name in sums],
    ).join(F.broadcast(offsets), [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in group], "left")
    zero = F.lit(0)
    return placed.select(
        *df.columns, (F.coalesce("_before", zero) + F.col("_place")).cast("long").alias(rank),
        *[(F.coalesce(f"_before_{name}", zero) + F.col(f"_upto_{name}")).alias(name) for name in sums],
    )
