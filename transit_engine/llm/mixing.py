"""Mixing sources to target weights by capped water-filling.

Weights share a total of words among the sources; a source gives at most ``epochs`` times its own
words. What is clamped goes back to the others in proportion to their weights, until none is above
its cap. A source's target becomes whole repetitions of all its documents and one fractional
repetition: documents in a seeded order as long as they fit, then a few times the document whose
size is nearest to what is still missing. Where that stays far from the target, because of documents
much longer than the others, the order is gone on with behind each document that doesn't fit. In a
source of few documents the fractional repetition is the best of all their subsets.

Only DataFrame functions. A source may hold most rows: it is cut into bins of the seeded order, and
only the bin in which the target falls is ordered row by row. Steps are a row per distinct document
or per source, and are written in files that follow their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transit_engine.llm.common import WORD, saved_narrow, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = 7
BIN_BITS = (10, 10)  # the seeded order of a source is cut into bins, the bin of the target again
ORDER_BITS = 60
FILLERS = 5  # times that a document of the size nearest to what is missing is added
NEAR = 0.01  # a source that misses more of its target sets aside documents one by one instead
FEW = 12  # documents of a source whose subsets are all looked at
RANGES = "array<struct<after:bigint,upto:bigint,limit:double>>"


def word_count(column: str = "text") -> Column:
    return F.size(F.regexp_extract_all(text_of(column), F.lit(WORD), F.lit(0))).cast("long")


def seeded_order(seed: int) -> Column:
    """A number below 2**60 from seed, doc_id and text; only rows alike in both are alike in it."""
    named = F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_of()
    )
    return F.conv(F.substring(F.md5(named), 1, ORDER_BITS // 4), 16, 10).cast("long")


def source_key(column: str = "source") -> Column:
    """Never null, so that documents without source can be joined as a source of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def ranked_sources(sizes: DataFrame, n_sources: int) -> DataFrame:
    """One row per source with its words and its rank by code point, null last.

    Ranks are counted per range of sources and shifted by what the ranges before hold, so that
    the number of sources isn't bounded by one task.
    """
    sources = sizes.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    last = F.col("source").asc_nulls_last()
    ranged = saved_narrow(
        sources.repartitionByRange(last).withColumn("part", F.spark_partition_id()), "sources", n_sources
    )
    before = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part",
        (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"),  # a row per range
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy(last)) - 1
    return ranged.withColumn("place", place).join(before, "part").select(
        "skey", "source_size", (F.col("before") + F.col("place")).alias("rank")
    )


def water_level(sources: DataFrame, total: float, epochs: float = EPOCHS) -> float:
    """The words that one unit of weight gets once no source is above its cap.

    Each round clamps the sources whose share exceeds their cap and deals what is left to the
    others; a round is one aggregate over the sources.
    """
    cap = F.col("source_size") * F.lit(epochs)
    level = 0.0
    while True:
        free = cap > F.col("weight") * F.lit(level)
        kept = sources.agg(
            F.sum(F.when(free, F.col("weight"))).alias("weight"),
            F.sum(F.when(~free, cap)).alias("clamped"),
        ).first()
        if not kept["weight"]:
            return level
        risen = (total - (kept["clamped"] or 0.0)) / kept["weight"]
        if risen <= level:
            return level
        level = risen


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS
) -> DataFrame:
    """skey, source_size, target: the words each source has and gives."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))
    n_sources = sizes.select("skey").distinct().count()
    sources = saved_narrow(
        ranked_sources(sizes, n_sources).withColumn("weight", weight), "source-weights", n_sources
    )
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level = water_level(sources, total, epochs)
    target = F.least(F.col("source_size") * F.lit(float(epochs)), F.col("weight") * F.lit(level))
    return sources.select("skey", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: int = SEED
) -> DataFrame:
    """doc_id, row (all columns of ``docs``), size, source_size, target and repeats: how often the
    mix takes the document.

    Size is the number of words, 0 for null or blank texts, which are never taken. Documents
    without source are one source, the last. Rows alike in doc_id and text are taken alike. An
    empty table, or one without words, takes nothing.
    """
    named = docs.select(
        F.struct(*docs.columns).alias("row"), "doc_id", "source", word_count().alias("size"),
        source_key().alias("skey"), seeded_order(seed).alias("u"),
    )
    n_docs = docs.count()
    sizes = saved_narrow(
        named.groupBy("skey", "source", "u").agg(
            F.sum("size").alias("size"), F.max("size").alias("each")
        ),
        "mix-units", n_docs,
    )
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    found = source_targets(sizes, weights, share, epochs)
    n_sources = found.count()
    targets = saved_narrow(
        found.withColumn("whole", whole.cast("long"))
        .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")),
        "targets", n_sources,
    )
    units = sizes.where(F.col("size") > 0).select("skey", "u", "size", "each")
    # Written, so that its size, a row per source, is known when the join is planned.
    cuts = saved_narrow(
        targets.join(_cuts(units, targets, n_docs), "skey", "left").select(
            "skey", "source_size", "target", "whole", "edge", "fillers", "ranges"
        ),
        "cuts", n_docs,
    )
    extra = (F.col("u") <= F.col("edge")) | F.array_contains("fillers", F.col("u")) | _within("size")
    repeats = F.col("whole") + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)
    return named.join(cuts, "skey").select(
        "doc_id", "row", "size", "source_size", "target",
        F.when(F.col("size") > 0, repeats).otherwise(F.lit(0)).cast("long").alias("repeats"),
    )


def _prefix(units: DataFrame, targets: DataFrame, n_units: int) -> DataFrame:
    """skey, part, edge, gap: documents up to ``edge`` fit into ``part``, the next one doesn't.

    Sources whose documents all fit are left out.
    """
    crossing = targets.select(
        "skey", "part", F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("before")
    )
    done = 0
    for bits in BIN_BITS:
        inside = units.withColumn("bin", F.shiftright("u", ORDER_BITS - done)).join(
            crossing, ["skey", "bin"]
        )
        done += bits
        bins = inside.groupBy(
            "skey", F.shiftright("u", ORDER_BITS - done).alias("bin"), "part", "before"
        ).agg(F.sum("size").alias("held"))
        upto = F.col("before") + F.sum("held").over(Window.partitionBy("skey").orderBy("bin"))
        crossing = saved_narrow(
            bins.withColumn("upto", upto)
            .where((F.col("upto") > F.col("part")) & (F.col("upto") - F.col("held") <= F.col("part")))
            .select("skey", "part", "bin", (F.col("upto") - F.col("held")).alias("before")),
            "crossing", n_units,
        )
    bin_of = F.shiftright("u", ORDER_BITS - done)
    running = F.sum("size").over(Window.partitionBy("skey").orderBy("u"))
    inside = (
        units.withColumn("bin", bin_of).join(crossing, ["skey", "bin"])
        .withColumn("upto", F.col("before") + running).where(F.col("upto") <= F.col("part"))
        .groupBy("skey").agg(F.max("u").alias("last"), F.max("upto").alias("upto"))
    )
    return saved_narrow(
        crossing.join(inside, "skey", "left").select(
            "skey", "part",
            F.coalesce(F.col("last"), F.shiftleft(F.col("bin"), ORDER_BITS - done) - 1).alias("edge"),
            (F.col("part") - F.coalesce(F.col("upto"), F.col("before"))).alias("gap"),
        ),
        "edges", n_units,
    )


def _cuts(units: DataFrame, targets: DataFrame, n_units: int) -> DataFrame:
    """skey, edge, fillers, ranges: what the fractional repetition takes.

    That is what comes up to ``edge``, or in sources with ``ranges`` what lies in one of them, and
    ``fillers``. ``units`` has at most ``n_units`` rows.
    """
    counts = units.groupBy("skey").agg(F.count(F.lit(1)).alias("n"))
    few = saved_narrow(counts.where(F.col("n") <= FEW).select("skey"), "few", n_units)
    best = _best_subsets(units.join(few, "skey"), targets)
    many = units.join(few, "skey", "left_anti")
    return best.unionByName(_many_cuts(many, targets, n_units))


def _best_subsets(units: DataFrame, targets: DataFrame) -> DataFrame:
    """The cuts of sources of few documents: of all subsets the one whose size is nearest to the part
    to be filled, of a tie the first in the seeded order."""
    documents = F.array_sort(F.collect_list(F.struct("u", "size")))
    listed = units.groupBy("skey").agg(documents.alias("documents")).join(
        targets.select("skey", "part"), "skey"
    )

    def with_document(subsets: Column, d: Column) -> Column:
        return F.concat(subsets, F.transform(subsets, lambda s: F.struct(
            (s["held"] + d["size"]).alias("held"), F.concat(s["us"], F.array(d["u"])).alias("us")
        )))

    none = F.array(F.struct(F.lit(0).cast("long").alias("held"), F.array().cast("array<bigint>").alias("us")))
    best = F.array_min(F.transform(
        F.aggregate("documents", none, with_document),
        lambda s: F.struct(F.abs(s["held"] - F.col("part")).alias("off"), s["us"].alias("us")),
    ))
    return listed.select(
        "skey", F.lit(-1).cast("long").alias("edge"), best["us"].alias("fillers"),
        F.array().cast(RANGES).alias("ranges"),
    )


def _many_cuts(units: DataFrame, targets: DataFrame, n_units: int) -> DataFrame:
    """The cuts of sources of many documents."""
    edges = _prefix(units, targets, n_units)
    cuts = edges.withColumn("fillers", F.array().cast("array<bigint>"))
    off = F.abs(F.col("size") - F.col("gap"))
    fresh = (F.col("u") > F.col("edge")) & ~F.array_contains("fillers", F.col("u"))
    for _ in range(FILLERS):
        nearest = (
            units.join(cuts, "skey").where(fresh & (off < F.col("gap"))).groupBy("skey")
            .agg(F.min(F.struct(off.alias("off"), F.col("u"), F.col("size"))).alias("best"))
        )
        taken = F.when(F.col("best").isNull(), F.col("fillers")).otherwise(
            F.concat("fillers", F.array("best.u"))
        )
        cuts = saved_narrow(
            cuts.join(nearest, "skey", "left").select(
                "skey", "edge", (F.col("gap") - F.coalesce("best.size", F.lit(0))).alias("gap"),
                taken.alias("fillers"),
            ),
            "fillers", n_units,
        )
    missed = F.abs(F.col("gap")) > F.col("target") * F.lit(NEAR)
    far = saved_narrow(
        cuts.join(targets.select("skey", "target", "part"), "skey").where(missed)
        .select("skey", "part", F.abs(F.col("gap")).alias("off")),
        "far", n_units,
    )
    cuts = cuts.select("skey", "edge", "fillers", F.array().cast(RANGES).alias("ranges"))
    if far.isEmpty():
        return cuts
    nearer = _ranges(units, far, n_units)
    return cuts.join(nearer, "skey", "left_anti").unionByName(nearer)


def _ranges(units: DataFrame, far: DataFrame, n_units: int) -> DataFrame:
    """The cuts of sources that come nearer when documents that don't fit are set aside one by one.

    Each round goes on behind the document that didn't fit, with those not larger than what is
    missing, until none of them is left; one of the size nearest to the rest may come last.
    """
    start = F.lit(-1).cast("long")
    state = saved_narrow(
        far.select("skey", "part", start.alias("after"), F.col("part").alias("gap"),
                   F.array().cast(RANGES).alias("ranges")),
        "ranges", n_units,
    )
    top = (1 << ORDER_BITS) - 1
    while True:
        fits = (F.col("u") > F.col("after")) & (F.col("each") <= F.col("gap"))
        left = saved_narrow(
            units.join(state.select("skey", "after", "gap"), "skey").where(fits)
            .select("skey", "u", "size", "each"),
            "left", n_units,
        )
        if left.isEmpty():
            break
        held = left.groupBy("skey").agg(F.sum("size").alias("held"))
        reached = _prefix(left, state.select("skey", F.col("gap").alias("part")), n_units)
        # What comes behind the edge didn't fit; where nothing did not, all is taken.
        blocks = left.join(reached, "skey").where(F.col("u") > F.col("edge")).groupBy("skey").agg(
            F.min("u").alias("block")
        )
        found = (
            state.join(held, "skey", "left").join(
                reached.select("skey", "edge", F.col("gap").alias("rest")), "skey", "left"
            ).join(blocks, "skey", "left")
        )
        gone = F.col("held").isNotNull()
        one = F.struct(
            F.col("after"), F.coalesce("edge", F.lit(top)).alias("upto"), F.col("gap").alias("limit")
        )
        state = saved_narrow(
            found.select(
                "skey", "part",
                F.when(gone, F.coalesce("block", F.lit(top))).otherwise(F.col("after")).alias("after"),
                F.when(gone, F.coalesce("rest", F.col("gap") - F.col("held"))).otherwise(F.col("gap"))
                .alias("gap"),
                F.when(gone, F.concat("ranges", F.array(one))).otherwise(F.col("ranges")).alias("ranges"),
            ),
            "ranges", n_units,
        )
    off = F.abs(F.col("size") - F.col("gap"))
    last = (
        units.join(state, "skey").where(~_within("each") & (off < F.col("gap"))).groupBy("skey")
        .agg(F.min(F.struct(off.alias("off"), F.col("u"))).alias("best"))
    )
    rest = F.coalesce("best.off", F.col("gap"))
    none = F.array().cast("array<bigint>")
    return saved_narrow(
        state.join(last, "skey", "left").join(far.select("skey", "off"), "skey").where(rest < F.col("off"))
        .select(
            "skey", start.alias("edge"),
            F.when(F.col("best").isNull(), none).otherwise(F.array("best.u")).alias("fillers"), "ranges",
        ),
        "nearer", n_units,
    )


def _within(size: str) -> Column:
    """Whether a document lies in one of the ranges of its source."""
    return F.exists(
        "ranges",
        lambda r: (F.col("u") > r["after"]) & (F.col("u") <= r["upto"]) & (F.col(size) <= r["limit"]),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document, with all its columns, as many times as it is taken."""
    taken = mix(docs, **options).where(F.col("repeats") > 0)
    copies = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("copy")
    return taken.select("row", copies).select("row.*")
