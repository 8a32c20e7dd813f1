"""Secret scans with multipart credential linking.

Every text is searched for base secrets (assignments, access keys, long hex strings). Besides,
weak parts are collected: names of accounts and keys (identifiers), long mixed strings (secrets)
and addresses (endpoints). On its own a weak part means nothing; it is reported only where what
complements it lies in the same scope, that is, at most ``SCOPE`` characters away.

Parts are linked by an interval join: every part is entered in the bins of the text that it
touches, and a weak part looks into the bins it can reach. Per bin, text and role only the first
start and the last end are kept, which is all that the test needs, so no pairs are made. Parts are
keyed by the text they come from; copies of a text share them.

Only DataFrame functions: positions are sums over the lengths of matches and of what lies between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_engine.llm.common import saved, text_of

SCOPE = 200  # characters between parts of one credential

# The base kinds in the order in which they are listed. ``{n,}`` stands where a run
# that is too short can't hide a longer one; assignments are measured after matching.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
ASSIGN_LENGTH = 8
# Weak kinds, listed after the base kinds.
IDENT = (
    r"""(?i)(?<![a-z0-9])(?:client_id|account_id|account|key_id|access_key_id|user_?name|user|login)"""
    r"""["']?\x20*[:=]\x20*["']?[a-z0-9@._+-]{3,}"""
)
KEY = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}"
ENDPOINT = r"""https?://[^\x20\x09-\x0D"'<>]+"""
KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")

ONE_SPAN = "struct<start: bigint, end: bigint, kind: int>"
SPAN = f"array<{ONE_SPAN}>"
BLOCK = 256  # items whose values are gathered before they are added to the others


def matches(pattern: str, text: Column, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, also where lambdas use it many times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(items: Column, zero: Column, step, made, of: str) -> Column:
    """``made(state, item)`` for each item, a value of SQL type ``of``, where ``state`` comes from ``zero``
    by ``step(state, item)`` over the items up to and with it.

    An array grows by copying, so values are gathered in blocks, and blocks in an array of them: an array
    of tens of thousands of items takes time in proportion to its length.
    """
    def within(state: Column, item: Column) -> Column:
        now = step(state["now"], item)
        return F.struct(
            now.alias("now"), F.concat(state["block"], F.array(made(now, item))).alias("block")
        )

    def over(state: Column, block: Column) -> Column:
        start = F.struct(state["now"].alias("now"), F.array().cast(f"array<{of}>").alias("block"))
        return once(
            F.aggregate(block, start, within),
            lambda r: F.struct(
                r["now"].alias("now"), F.concat(state["blocks"], F.array(r["block"])).alias("blocks")
            ),
        )

    def cut(whole: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(whole), F.lit(1)), F.lit(BLOCK)),
            lambda at: F.slice(whole, at, F.lit(BLOCK)),
        )

    first = F.struct(zero.alias("now"), F.array().cast(f"array<array<{of}>>").alias("blocks"))
    return F.aggregate(once(items, cut), first, over, lambda state: F.flatten(state["blocks"]))


def found(pattern: str, kind: int, text: Column, keep=None, group: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches; ``keep(part)`` drops some by their ``group``.

    Positions are code points from 0, the end is exclusive. Each pattern runs over the text a fixed
    number of times, however many matches there are.
    """
    whole, between = matches(pattern, text), F.split(text, pattern, -1)
    parts = whole if not group else matches(pattern, text, group)
    # What follows the last match has no match beside it: cut it off.
    pairs = F.transform(
        F.arrays_zip(
            F.slice(between, F.lit(1), F.size(whole)).alias("gap"), whole.alias("match"),
            parts.alias("part"),
        ),
        lambda p: F.struct(
            F.length(p["gap"]).cast("long").alias("gap"), F.length(p["match"]).cast("long").alias("length"),
            (keep(p["part"]) if keep else F.lit(True)).alias("stays"),
        ),
    )
    spans = running(
        pairs, F.lit(0).cast("long"), lambda at, pair: at + pair["gap"] + pair["length"],
        lambda at, pair: F.struct(
            (at - pair["length"]).alias("start"), at.alias("end"),
            F.when(pair["stays"], F.lit(kind)).alias("kind"),
        ),
        ONE_SPAN,
    )
    spans = F.filter(spans, lambda span: span["kind"].isNotNull()) if keep else spans
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def _long_enough(part: Column) -> Column:
    return F.length(part) >= ASSIGN_LENGTH


def _mixed(part: Column) -> Column:
    return part.rlike("[0-9]") & part.rlike("[A-Za-z]")


def _apart(spans: Column, others: Column) -> Column:
    """The spans that touch none of the others: none that starts at or before them reaches into them, none starts in them.

    Both are put in one order by start. A pass from the left carries the last end of the others, one from
    the right the first start.
    """
    def marked(side: Column, other: bool) -> Column:
        return F.transform(
            side,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(0 if other else 1).alias("side"), s["end"].alias("end"),
                s["kind"].alias("kind"), F.lit(True).alias("free"),
            ),
        )

    def swept(items: Column, zero: int, further, clear) -> Column:
        return running(
            items, F.lit(zero).cast("long"),
            lambda edge, s: F.when(s["side"] == 0, further(edge, s)).otherwise(edge),
            lambda edge, s: F.struct(
                s["start"].alias("start"), s["side"].alias("side"), s["end"].alias("end"),
                s["kind"].alias("kind"), (s["free"] & clear(edge, s)).alias("free"),
            ),
            "struct<start: bigint, side: int, end: bigint, kind: int, free: boolean>",
        )

    # Others come before spans of the same start, so the pass from the left sees them.
    both = F.array_sort(F.concat(marked(spans, False), marked(others, True)))
    left = swept(
        both, -1, lambda edge, s: F.greatest(edge, s["end"]), lambda edge, s: edge <= s["start"]
    )
    right = swept(
        F.reverse(left), 1 << 62, lambda edge, s: F.least(edge, s["start"]),
        lambda edge, s: edge >= s["end"],
    )
    free = F.filter(F.reverse(right), lambda s: (s["side"] == 1) & s["free"])
    free = F.transform(
        free, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return F.when(F.size(spans) > 0, free).otherwise(F.array().cast(SPAN))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans), weak (spans), text_key (only where there are weak parts)."""
    text = F.col("text")
    base = (
        docs.select("doc_id", text_of().alias("text"))
        .withColumn("assign", found(ASSIGN, 0, text, _long_enough, 2))
        .withColumn("access", found(ACCESS, 1, text))
        .withColumn("hex", found(HEX, 2, text))
        .withColumn("base", F.array_sort(F.concat("assign", "access", "hex"), _by_place))
        .withColumn("ident", found(IDENT, 3, text))
        .withColumn("key", found(KEY, 4, text, _mixed))
        .withColumn("endpoint", found(ENDPOINT, 5, text))
    )
    keys = _apart(F.col("key"), F.concat("base", "ident", "endpoint"))
    return (
        base.withColumn("weak", F.concat("ident", keys, "endpoint"))
        .withColumn("text_key", F.when(F.size("weak") > 0, F.sha2("text", 256)))
        .select("doc_id", "base", "weak", "text_key")
    )


def _by_place(a: Column, b: Column) -> Column:
    def order(x: Column, y: Column) -> Column:
        return F.when(x < y, -1).when(x > y, 1)

    return F.coalesce(
        order(a["start"], b["start"]), order(a["kind"], b["kind"]), order(a["end"], b["end"]),
        F.lit(0),
    )


def linked(scan: DataFrame, scope: int = SCOPE) -> DataFrame:
    """text_key, links: the weak spans of each text that have what complements them in scope.

    A secret needs an identifier or an endpoint, an identifier needs a secret, an endpoint needs
    both. Access keys count as identifiers, assignments and hex strings as secrets.
    """
    spans = scan.where(F.col("text_key").isNotNull()).select(
        "text_key", F.explode(F.concat("base", "weak")).alias("span")
    )
    role = (
        F.when(F.col("span.kind").isin(1, 3), "identifier")
        .when(F.col("span.kind") == 5, "endpoint").otherwise("secret")
    )
    parts = saved(
        spans.select("text_key", "span.start", "span.end", "span.kind", role.alias("role")).distinct(),
        "credential-parts",
    )
    first, last = F.expr(f"start div {scope}"), F.expr(f"(end - 1) div {scope}")
    bins = (
        parts.withColumn("bin", F.explode(F.sequence(first, last)))
        .groupBy("text_key", "bin", F.col("role").alias("other"))
        .agg(F.min("start").alias("lo"), F.max("end").alias("hi"))
    )
    near = (F.col("start") - F.col("hi") <= scope) & (F.col("lo") - F.col("end") <= scope)
    seen = (
        parts.where(F.col("kind") >= 3)
        .withColumn("bin", F.explode(F.sequence(first - 1, last + 1)))
        .join(bins, ["text_key", "bin"]).where(near & (F.col("role") != F.col("other")))
        .groupBy("text_key", "start", "end", "kind", "role").agg(
            *[F.max(F.col("other") == r).alias(f"has_{r}") for r in ("identifier", "secret", "endpoint")]
        )
    )
    complete = (
        F.when(F.col("role") == "secret", F.col("has_identifier") | F.col("has_endpoint"))
        .when(F.col("role") == "identifier", F.col("has_secret"))
        .otherwise(F.col("has_identifier") & F.col("has_secret"))
    )
    return seen.where(complete).groupBy("text_key").agg(
        F.collect_list(F.struct("start", "end", "kind")).alias("links")
    )


def secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, base (spans), spans (base and linked ones): one row per row of ``docs``.

    Spans have start, end (code points, exclusive) and kind (a place in ``KINDS``), by start and
    then kind. Null counts as empty, an empty text has no spans; repeated rows are scanned alike;
    other columns are not looked at. The time for a text grows with its length, also where
    matches are dense.
    """
    scan = saved(scanned(docs), "secret-scan")
    lone = scan.where(F.col("text_key").isNull()).select("doc_id", "base", F.col("base").alias("spans"))
    links = saved(linked(scan, scope), "credential-links")
    spans = F.when(F.col("links").isNull(), F.col("base")).otherwise(
        F.array_sort(F.concat("base", "links"), _by_place)
    )
    rest = scan.where(F.col("text_key").isNotNull()).join(links, "text_key", "left")
    return lone.unionByName(rest.select("doc_id", "base", spans.alias("spans")))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )
