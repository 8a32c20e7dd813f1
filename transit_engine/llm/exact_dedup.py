"""Exact deduplication over an extendible-hash index on shared files.

1. Every row gets the hash of its normalised text, kept with its digest as a narrow written table.
2. The directory is made over the distinct hashes. It starts with one bucket; a bucket that holds
   more than ``capacity`` hashes is split by one more bit, which doubles the directory, until no
   bucket is overfull. One count settles all doublings up to the depth that evenly spread hashes
   need; what is overfull beyond is split on in further rounds. A bucket is a range of hashes.
3. The texts are sent to the owner tasks of their buckets, once. An owner compares bytes along the
   chain of each hash, so that equal texts become one entry, and writes its buckets as sorted
   pages. Texts of very frequent hashes are folded in the map tasks before, so that a group of
   copies of any size reaches its owner as one row.
4. Each row finds its entry by directory, page and chain: bucket, hash and digest.

Only DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transit_engine.llm.common import GAP, saved, text_of

CAPACITY = 500  # hashes of a bucket
SENT_SLOTS = 4_000_000  # a level of the directory is sent to all tasks up to here, and joined beyond
# A hash is frequent from this many rows on, or this share of all rows, so at most 100,000 are.
FREQUENT, FREQUENT_SHARE = 100, 100_000

Directory = list[tuple[int, DataFrame]]


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), GAP, " ")


def cell_of(hashed: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit hash."""
    return F.shiftrightunsigned(hashed, 64 - depth) if depth else F.lit(0).cast("long")


def _bits_for(n: int, capacity: int) -> int:
    """Bits that part ``n`` evenly spread hashes into buckets, and two more for uneven ones."""
    return max(0, math.ceil(math.log2(max(n, 1) / capacity))) + 2


def directory(hashes: DataFrame, capacity: int = CAPACITY) -> Directory:
    """Levels of the directory over distinct hashes ``h``: (bits, slots), slots (cell, depth, bucket).

    ``cell`` is the first ``bits`` bits of a hash, ``depth`` the number of bits that its bucket is told
    apart by, ``bucket`` the first hash of that bucket. Several cells share a bucket of few hashes. A
    cell that is still overfull has no slot; its hashes are in the next level. At 64 bits a cell
    holds one hash, so no bucket is left overfull.
    """
    levels: Directory = []
    low, bits, left = 0, min(64, _bits_for(hashes.count(), capacity)), hashes
    while True:
        cells = saved(
            left.groupBy(cell_of(F.col("h"), bits).alias("cell")).agg(F.count("*").alias("n")), "cells"
        )
        doublings = cells.select(
            "cell", "n", F.explode(F.sequence(F.lit(low), F.lit(bits))).alias("depth")
        ).withColumn("slot", F.expr(f"shiftrightunsigned(cell, {bits} - depth)"))
        fitting = doublings.groupBy("depth", "slot").agg(F.sum("n").alias("held")).where(
            F.col("held") <= capacity
        )
        depths = doublings.join(fitting, ["depth", "slot"]).groupBy("cell").agg(
            F.min("depth").alias("depth")
        )
        bucket = F.expr(f"shiftleft(shiftrightunsigned(cell, {bits} - depth), 64 - depth)")
        levels.append((bits, saved(depths.select("cell", "depth", bucket.alias("bucket")), "directory")))
        if bits == 64:
            return levels
        overfull = cells.where(F.col("n") > capacity)
        worst = overfull.agg(F.max("n")).first()[0]
        if worst is None:
            return levels
        left = left.withColumn("cell", cell_of(F.col("h"), bits)).join(
            overfull.select("cell"), "cell", "left_semi"
        ).select("h")
        low, bits = bits + 1, min(64, bits + _bits_for(worst, capacity))


def in_buckets(rows: DataFrame, levels: Directory) -> DataFrame:
    """``rows`` with the bucket of their hash ``h``, found in the directory."""
    names = []
    for bits, slots in levels:
        level = slots.select(
            F.col("cell").alias(f"cell_{bits}"), F.col("bucket").alias(f"bucket_{bits}")
        )
        if slots.count() <= SENT_SLOTS:
            level = F.broadcast(level)
        rows = rows.withColumn(f"cell_{bits}", cell_of(F.col("h"), bits))
        rows = rows.join(level, f"cell_{bits}", "left").drop(f"cell_{bits}")
        names.append(f"bucket_{bits}")
    return rows.withColumn("bucket", F.coalesce(*names)).drop(*names)


def index_pages(rows: DataFrame, counts: DataFrame, levels: Directory) -> DataFrame:
    """The distinct texts as written pages: (bucket, h, link, text_sha256, keep_id, group_size).

    ``rows`` has doc_id, h and body, ``counts`` the number of rows per hash (h, n). Owner tasks take
    buckets whole; links of a chain are told apart by their bytes.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = saved(
        counts.where(F.col("n") > max(FREQUENT, total // FREQUENT_SHARE)).select("h"), "frequent"
    )
    single = rows.select("h", "body", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
    if not frequent.isEmpty():
        told = F.broadcast(frequent)  # at most FREQUENT_SHARE rows
        folded = single.join(told, "h", "left_semi").groupBy("h", "body").agg(
            F.min("keep_id").alias("keep_id"), F.sum("n").alias("n")
        )
        single = single.join(told, "h", "left_anti").unionByName(folded)
    entries = (
        in_buckets(single, levels).repartition("bucket").groupBy("bucket", "h", "body")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
        .select("bucket", "h", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    chain = Window.partitionBy("bucket", "h").orderBy(
        F.col("keep_id").asc_nulls_last(), "text_sha256"
    )
    return saved(entries.withColumn("link", F.row_number().over(chain)), "index-pages")


def exact_groups(
    docs: DataFrame,
    hashed: Callable[[Column], Column] = F.xxhash64,
    capacity: int = CAPACITY,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, link: one row per row of ``docs``.

    Texts are equal when identical after each run of white space became one space; null counts as
    empty, and all empty texts are one group. Of equal texts the row with the smallest doc_id is
    kept. Rows that repeat both doc_id and text are marked alike (``survivors`` leaves one). Rows
    without doc_id come last: they are kept only where no row of their group has one. Other
    columns are not looked at. An empty table gives an empty result. ``link`` is the place of the
    text in the chain of its hash, 1 unless two texts share a hash.
    """
    rows = docs.select("doc_id", normalised().alias("body")).withColumn(
        "h", hashed(F.col("body")).cast("long")
    )
    keys = saved(rows.select("doc_id", "h", F.sha2("body", 256).alias("text_sha256")), "text-keys")
    counts = saved(keys.groupBy("h").agg(F.count("*").alias("n")), "text-hashes")
    levels = directory(counts.select("h"), capacity)
    pages = index_pages(rows, counts, levels)
    found = in_buckets(keys, levels).join(pages, ["bucket", "h", "text_sha256"])
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", "link",
    )


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat both doc_id and
    text, one."""
    dropped = exact_groups(docs).where(~F.col("kept")).select("doc_id", "text_sha256").distinct()
    # A row travels as one struct, so that none of its columns can clash.
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), "doc_id", F.sha2(normalised(), 256).alias("sha")
    )
    gone = dropped.select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha"))
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("sha") == F.col("gone_sha"))
    repeats = Window.partitionBy("doc_id", "sha").orderBy("sha")
    return (
        rows.join(gone, same, "left_anti").withColumn("copy", F.row_number().over(repeats))
        .where(F.col("copy") == 1).select("row.*")
    )
