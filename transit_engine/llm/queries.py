"""The query of each operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_engine.llm import (
    bpe,
    centroid_clusters,
    embedding_dedup,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    oracle,
    periodic_runs,
    quality,
    secret_scan,
    simhash,
    suffix_dedup,
)
from transit_engine.llm.common import WORD, table, text_of
from transit_engine.session import configure

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    _QUERIES[build.__name__] = run
    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def sql() -> dict[str, str]:
    return dict(oracle.SQL)


@query
def op1_simhash_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("link")


@query
def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(quality.bucket_of("doc_id", 4) == 2, F.lit(False))
    model = language_id.train(docs.where(~held_out))
    found = language_id.identified(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


@query
def op4_line_dedup(spark, sf_dir):
    cut = line_dedup.without_boilerplate(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_left"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


@query
def op5_quality_rules(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.scored(docs, labels).select("doc_id", "held_out", "score", "predicted")


@query
def op6_secret_scan(spark, sf_dir):
    found = secret_scan.secrets(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"),
    )


@query
def op7_source_mixture(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken")
    )


@query
def op8_byte_bpe(spark, sf_dir):
    coded = bpe.encoded(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_license_scan(spark, sf_dir):
    return license_scan.licenses(table(spark, sf_dir, "documents"))


@query
def op10_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op11_centroid_clusters(spark, sf_dir):
    return centroid_clusters.described(centroid_clusters.clustered(table(spark, sf_dir, "embeddings")))


def with_planted_runs(docs):
    """Every tenth document by hash of its id repeats words from some place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    begin = (g % F.col("n")).cast("int")
    period = (1 + F.floor((F.col("n") - F.col("begin")) / (3 + g % 8))).cast("int")
    said = F.transform("words", lambda word, i: F.when(i < F.col("begin"), word).otherwise(
        F.get("words", F.col("begin") + (i - F.col("begin")) % F.col("period"))
    ))
    hit = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, words)
    ).withColumn("n", F.when(n > 0, n))
    placed = hit.withColumn("begin", begin).withColumn("period", period)
    return placed.select("doc_id", F.coalesce(F.array_join(F.when(F.col("n") > 0, said), " "), "text").alias("text"))


@query
def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # The longest; of a tie the first start, then the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
    )))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    period = -F.col("best.period")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), period.alias("period"),
        F.floor(1000 * F.col("best.length") / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
