"""Quality scores by a sparse ensemble of rules over text statistics.

Statistics of whole texts are Spark columns. Trees are grown on the labelled rows; every path from
a root to a node becomes a rule, a conjunction of bounds on statistics. A logistic regression with
an L1 penalty weighs the rules and drops most of them. What is left is compiled into one column
expression, so that scoring needs neither Python nor a model object.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.llm.common import GAP, saved, text_of

MAX_ROWS = 100_000  # labelled rows that the model is fitted on, chosen by a hash of doc_id
TREES, DEPTH, MIN_ROWS = 12, 4, 10
PENALTY = 0.001
SEED = 5

STATISTICS = (
    "n_chars", "n_words", "letters", "digits", "capitals", "symbols", "stops", "commas", "lines",
    "word_length", "long_words", "short_words", "distinct_words", "distinct_lines", "line_ends",
    "repeats",
)


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.when(whole > 0, whole), F.lit(0.0))


def _left(text: str | Column, pattern: str) -> Column:
    """How many characters stay when the pattern is taken out."""
    return F.length(F.regexp_replace(text, pattern, ""))


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and ``STATISTICS``, doubles without nulls, of the whole text (null: empty)."""
    n = F.col("_n").cast("double")
    words, lines = F.size("_words").cast("double"), F.size("_lines").cast("double")
    step1 = docs.select(*keep, text_of().alias("_text"))
    step2 = step1.withColumns({
        "_n": F.length("_text"),
        "_rest": F.regexp_replace("_text", r"\p{L}+", ""),
        "_words": F.filter(F.split("_text", GAP), lambda w: w != ""),
        "_lines": F.filter(F.split("_text", "\n"), lambda s: F.trim(s) != ""),
    })
    step3 = step2.withColumn("_letters", n - F.length("_rest"))
    following = F.zip_with(
        F.slice("_words", F.lit(2), F.greatest(F.size("_words") - 1, F.lit(0))),
        F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 1, F.lit(0))),
        lambda a, b: (a == b).cast("int"),
    )
    ended = F.size(F.filter("_lines", lambda s: F.rtrim(s).rlike(r"[.!?]$")))
    return step3.select(
        *keep,
        F.log1p(n).alias("n_chars"),
        F.log1p(words).alias("n_words"),
        _share(F.col("_letters"), n).alias("letters"),
        _share(_left("_rest", "[^0-9]+"), n).alias("digits"),
        _share(_left("_text", r"\P{Lu}+"), F.col("_letters")).alias("capitals"),
        _share(_left("_rest", r"[^#$%&*|@<>{}\[\]\\^~_=+/]+"), n).alias("symbols"),
        _share(_left("_rest", "[^.!?]+"), words).alias("stops"),
        _share(_left("_rest", "[^,;:]+"), words).alias("commas"),
        _share(lines, words).alias("lines"),
        _share(F.col("_letters"), words).alias("word_length"),
        _share(F.size(F.filter("_words", lambda w: F.length(w) > 14)), words).alias("long_words"),
        _share(F.size(F.filter("_words", lambda w: F.length(w) < 4)), words).alias("short_words"),
        _share(F.size(F.array_distinct("_words")), words).alias("distinct_words"),
        _share(F.size(F.array_distinct("_lines")), lines).alias("distinct_lines"),
        _share(ended, lines).alias("line_ends"),
        _share(F.aggregate(following, F.lit(0), lambda a, x: a + x), words).alias("repeats"),
    )


@dataclass(frozen=True)
class Rule:
    """A conjunction: for some statistics an open lower and a closed upper bound."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        tests = []
        for name, low, high in self.bounds:
            if low > float("-inf"):
                tests.append(F.col(name) > F.lit(low))
            if high < float("inf"):
                tests.append(F.col(name) <= F.lit(high))
        return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The probability of label 1 as a column over ``STATISTICS``."""
        terms = [F.when(rule.column(), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.weights]
        margin = reduce(lambda a, b: a + b, terms, F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def tree_paths(description: str, names: tuple[str, ...]) -> set[Rule]:
    """The rules of a printed tree: one for every node below the root."""
    rules, open_tests = set(), []
    line = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")
    for match in filter(None, map(line.match, description.splitlines())):
        depth, feature, test, value = len(match[1]), int(match[2]), match[3], float(match[4])
        open_tests = [t for t in open_tests if t[0] < depth] + [(depth, feature, test, value)]
        bounds: dict[int, tuple[float, float]] = {}
        for _, f, t, x in open_tests:
            low, high = bounds.get(f, (float("-inf"), float("inf")))
            bounds[f] = (low, min(high, x)) if t == "<=" else (max(low, x), high)
        rules.add(Rule(tuple((names[f], *bounds[f]) for f in sorted(bounds))))
    return rules


def fit(labelled: DataFrame, max_rows: int = MAX_ROWS) -> RuleModel:
    """A model from ``STATISTICS``, doc_id and label (0 or 1; other rows are left out).

    Without rows of both labels the model is the share of label 1 (0.5 without rows).
    """
    known = saved(labelled.where(F.col("label").isin(0, 1)), "quality-labels")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return RuleModel({0: -10.0, 1: 10.0}[next(iter(counts))] if counts else 0.0, ())
    chosen = F.xxhash64("doc_id", F.lit(SEED)).bitwiseAND(F.lit((1 << 32) - 1)) < F.lit(
        int(min(1.0, max_rows / total) * (1 << 32))
    )
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="statistics").transform(
        known.where(chosen).withColumn("label", F.col("label").cast("double"))
    )
    forest = RandomForestClassifier(
        featuresCol="statistics", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=MIN_ROWS,
        featureSubsetStrategy="onethird", seed=SEED,
    ).fit(rows)
    found = set().union(*[tree_paths(t.toDebugString, STATISTICS) for t in forest.trees])
    rules = sorted(found, key=lambda r: r.bounds)
    if not rules:
        share = counts[1] / total
        return RuleModel(_logit(share), ())
    flags = rows.select(
        "label", F.array(*[r.column().cast("double") for r in rules]).alias("flags")
    )
    lasso = LogisticRegression(
        featuresCol="rules", regParam=PENALTY, elasticNetParam=1.0, maxIter=60
    ).fit(saved(flags.select("label", array_to_vector("flags").alias("rules")), "quality-rules"))
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleModel(float(lasso.intercept), tuple(weights))


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def bucket_of(column: str, buckets: int) -> Column:
    """crc32 of an id as text, modulo ``buckets``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % buckets


HELD_OUT = 1


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and ``STATISTICS``: one row per row of ``docs``.

    Learns ``labels.quality`` from the rows whose crc32(doc_id) mod 3 is not 1. Null texts count
    as empty and get a score like any other; labels that contradict each other, or that repeat,
    each count; ids without text or label teach nothing; rows without doc_id are scored and not
    held out. An empty table gives an empty result; without usable labels every score is 0.5.
    """
    table = saved(with_statistics(docs, "doc_id"), "text-statistics")
    held_out = F.coalesce(bucket_of("doc_id", 3) == HELD_OUT, F.lit(False))
    known = labels.select("doc_id", F.col("quality").alias("label"))
    model = fit(table.where(~held_out).join(known, "doc_id"))
    result = table.withColumn("held_out", held_out).withColumn("score", model.score())
    return result.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model predicts 1 for, scored in place: no text is shuffled."""
    table = saved(with_statistics(docs, "doc_id"), "text-statistics")
    known = labels.select("doc_id", F.col("quality").alias("label"))
    held_out = F.coalesce(bucket_of("doc_id", 3) == HELD_OUT, F.lit(False))
    model = fit(table.where(~held_out).join(known, "doc_id"))
    # The row travels as one struct, so that none of its columns can clash with a statistic.
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    good = with_statistics(rows, "row").where(model.score() >= 0.5)
    return good.select("row.*")
