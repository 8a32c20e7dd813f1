"""Building blocks shared by the operators: one row per key, best rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transit_engine.operators.ranked import in_order, sort_columns

GROUP_LIMIT = 1000  # Spark's own bound for limiting groups ahead of the shuffle


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key: the smallest by the other columns, nulls first.

    A plain aggregate, so copies of a key collapse in the map tasks before the shuffle and a
    key that holds a large part of the rows costs its tasks no more than any other.
    """
    rest = [name for name in df.columns if name not in keys]
    smallest = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return smallest.select(
        *[F.col(name) if name in keys else F.col(f"_row.{name}").alias(name) for name in df.columns]
    )


def best_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int, rank: str | None = None
) -> DataFrame:
    """The first ``limit`` rows of each key.

    Spark plans ``row_number() <= limit`` as a group limit ahead of the shuffle: each map task
    sends at most ``limit`` rows per key. Above ``GROUP_LIMIT`` Spark does not; then all rows are
    ranked by stretches of their order, which works for any limit and any size of a key.
    """
    name = rank or "_rank"
    if limit > GROUP_LIMIT:
        ranked = in_order(df, keys, order, name).where(F.col(name) <= limit)
        ranked = ranked.withColumn(name, F.col(name).cast("int"))
    else:
        window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        ranked = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= limit)
    return ranked if rank else ranked.drop(name)


def top_rows(
    df: DataFrame, order: Sequence[str], limit: int | None, city: str | None = None
) -> DataFrame:
    """A report: of one city (sorted, top-k), or the same report for every city at once."""
    if city is not None:
        report = df.where(F.col("city") == city).orderBy(
            *sort_columns(order)
        )
        return report if limit is None else report.limit(limit)
    if limit is None:
        return df.orderBy("city", *sort_columns(order))
    return best_per_key(df, ["city"], order, limit)
