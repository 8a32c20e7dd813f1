"""Line deduplication by how many distinct sites a line is spread over.

Every line is hashed. Per hash a HyperLogLog sketch of the sites is built in the map tasks and
merged by aggregation. An estimate far from the threshold decides at once; lines near it get an
exact count of distinct sites. Lines on enough sites are boilerplate and are taken out of every
text, wherever they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.llm.common import saved, text_of

MIN_SITES = 5
LG_BUCKETS = 10
NEAR = 0.5  # estimates within this share of the threshold are counted exactly
SENT_HASHES = 500_000  # hashes of lines that are sent to the lines, a few dozen megabytes


def trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def line_table(docs: DataFrame, site: str = "source") -> DataFrame:
    """doc_id, text_key, place, h, site: one row per line that isn't blank.

    What is cut from a text depends on its lines only, so rows are keyed by doc_id and text.
    """
    rows = docs.select(
        "doc_id", F.xxhash64(text_of()).alias("text_key"), F.col(site).alias("site"),
        F.posexplode(F.split(text_of(), "\n", -1)).alias("place", "line"),
    ).withColumn("line", trimmed(F.col("line")))
    return rows.where(F.col("line") != "").select(
        "doc_id", "text_key", "place", F.xxhash64("line", F.length("line")).alias("h"), "site"
    )


def _listed(lines: DataFrame, hashes: DataFrame) -> DataFrame:
    """The lines whose hash is in a written list.

    The list is counted: a short one is sent to the lines, which stay where they are, however common
    one of them is; a long one is joined, and adaptive execution splits a common line.
    """
    return lines.join(F.broadcast(hashes) if hashes.count() <= SENT_HASHES else hashes, "h", "left_semi")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, near: float = NEAR) -> DataFrame:
    """h, sites of the lines on at least ``min_sites`` sites; sites counted exactly near it."""
    sketches = lines.groupBy("h").agg(
        F.count("*").alias("n"), F.hll_sketch_agg("site", F.lit(LG_BUCKETS)).alias("sketch")
    )
    # A line can't be on more sites than it has rows.
    spread = saved(
        sketches.where(F.col("n") >= min_sites)
        .select("h", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - near)),
        "line-spread",
    )
    far = F.col("sites") > min_sites * (1 + near)
    # Lines of one site fold in the map tasks, so that a common line brings a row per task and site.
    per_site = _listed(lines.select("h", "site"), spread.where(~far).select("h")).distinct()
    counted = per_site.groupBy("h").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites)
    return spread.where(far).unionByName(counted)


def without_boilerplate(
    docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """doc_id, text, n_lines, n_removed: one row per row of ``docs``, boilerplate lines taken out.

    Lines end at line feeds and are compared after trimming white space; blank lines are no lines
    and stay. Rows without site count for no site, but lose boilerplate like others. A null text
    stays null with 0 lines; repeated rows are alike. Other columns are not looked at.
    """
    lines = saved(line_table(docs, site), "lines")
    spread = saved(boilerplate(lines, min_sites).select("h"), "boilerplate")
    cut = saved(
        _listed(lines, spread).groupBy("doc_id", "text_key")
        .agg(F.collect_set("place").alias("cut")),
        "line-cuts",
    )
    keyed = docs.select("doc_id", "text", F.xxhash64(text_of()).alias("text_key"))
    same = keyed["doc_id"].eqNullSafe(cut["doc_id"]) & (keyed["text_key"] == cut["text_key"])
    joined = keyed.join(cut, same, "left").select(keyed["doc_id"], "text", "cut")
    every = F.split("text", "\n", -1)
    kept = F.filter(every, lambda line, place: ~F.array_contains("cut", place))
    written = F.size(F.filter(every, lambda line: trimmed(line) != ""))
    return joined.select(
        "doc_id",
        F.when(F.col("cut").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(written).cast("long").alias("n_lines"),
        F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("n_removed"),
    )
