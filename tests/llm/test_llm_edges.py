"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from transit_engine.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    quality,
    queries,
    secret_scan,
    simhash,
)
from transit_engine.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside, as columns of the input.
EXTRA = (
    "row h body cell bucket link kept keep_id group_size text_sha256 sha copy fp root node half key u v "
    "size source_size target repeats skey edge filler letters capitals score label predicted held_out "
    "base weak spans kind place line cut text_key ids decoded n_tokens license dice lang_pred accepted"
).split()
LONG = "lorem ipsum dolor sit amet " * 20_000
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", None, 3),
    (4, "same text here for all", "en", "a", 22),
    (5, "same  text here\nfor all", "en", "b", 23),
    (5, "same  text here\nfor all", "en", "b", 23),
    (None, "same text here for all", None, None, None),
    (6, LONG, "en", "a", len(LONG)),
    (7, "1234 5678", "en", "b", 9),
    (8, "é😀字 token=abcdefgh12", "fr", "ß", 5),
    (9, "Released under the MIT License.", "en", "a", 5),
    (10, "un texte tout simple en langue connue", "fr", "b", 5),
    (11, "a plain text of a known language", "en", "b", 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.withColumns({name: F.lit("x") for name in EXTRA})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where(F.lit(False))


def labels(spark):
    rows = [(4, 1, 0), (4, 1, 0), (6, 0, None), (7, None, None), (None, 1, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def encoded(docs):
    return bpe.encoded(docs, queries.public_tokenizers.path("byte_bpe_50k.tiktoken"), queries.public_tokenizers.PATTERN)


def identified(docs):
    return language_id.identified(docs, language_id.train(docs))


PER_ROW = {
    "simhash": simhash.near_duplicates, "exact": exact_dedup.exact_groups, "language": identified,
    "lines": line_dedup.without_boilerplate,
    "quality": lambda d: quality.scored(d, labels(d.sparkSession)),
    "secrets": secret_scan.secrets, "mix": mixing.mix, "bpe": encoded,
    "licenses": license_scan.licenses,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row_and_none_for_none(docs, empty, name):
    assert sorted(r["doc_id"] or 0 for r in PER_ROW[name](docs).collect()) == sorted(
        r[0] or 0 for r in ROWS
    )
    assert PER_ROW[name](empty).collect() == []


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_all_columns(spark, docs, empty, stage, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    run = dict(corpus_pipeline.STAGES)[stage]
    kept = run(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert set(map(tuple, kept.collect())) <= set(map(tuple, docs.collect()))
    assert run(spark, empty, str(tmp_path)).collect() == []


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_exact_copies(docs):
    rows = exact_dedup.exact_groups(docs).collect()
    same = [r for r in rows if r["keep_id"] == 4]
    assert len(same) == 4 and all(r["group_size"] == 4 for r in same)
    assert [r["doc_id"] for r in same if r["kept"]] == [4]
    # Null and empty are one text; blanks are another.
    assert {r["doc_id"]: r["keep_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1: 1, 2: 1, 3: 3}


def test_one_id_on_several_texts_loses_none_of_them(spark):
    """A copy goes, another text of the same id stays; of near copies with one id one stays."""
    long = " ".join(f"w{k}" for k in range(400))
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "other words"), (2, "other words"), (3, long), (3, long + " x"),
            (None, "a b c d e"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {name: F.lit("x") for name in ("row", "text_key", "fp", "gone_id", "row_key", "first")}
    )
    kept = [(r["doc_id"], r["text"]) for r in simhash.survivors(docs).collect()]
    assert {(1, "a b c d e"), (2, "other words"), (None, "a b c d e"), (4, None)} <= set(kept)
    assert (2, "a b c d e") not in kept and kept.count((2, "other words")) == 2
    assert [doc_id for doc_id, _ in kept].count(3) == 1


def test_survivors_of_repeated_rows(spark):
    rows = [(7, "twice"), (7, "twice"), (7, "other"), (None, "none"), (None, "none"), (8, "other ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, exact_dedup.survivors(docs).collect()), key=repr)
    assert kept == [(7, "other"), (7, "twice"), (8, "other "), (None, "none")]


def test_rows_without_id_are_kept_only_alone(spark):
    docs = spark.createDataFrame([(None, "a"), (3, "a"), (None, "b")], "doc_id long, text string")
    rows = {(r["doc_id"], r["keep_id"]): r["kept"] for r in exact_dedup.exact_groups(docs).collect()}
    assert rows == {(None, 3): False, (3, 3): True, (None, None): True}


def test_texts_without_words_share_a_fingerprint(docs):
    rows = by_id(simhash.near_duplicates(docs))
    assert [rows[i]["fp"] for i in (1, 2, 3)] == [0, 0, 0]
    assert [rows[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1]
    assert rows[5]["component_id"] == 4 and rows[None]["component_id"] == 4


def test_languages_of_odd_texts(docs):
    rows = by_id(identified(docs))
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (1, 2, 3, 7))
    assert (rows[10]["lang_pred"], rows[11]["lang_pred"]) == ("fr", "en")


def test_no_language_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None), (None, "text", "en")], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in identified(docs).collect()} == {"und"}


def test_quality_without_usable_labels(spark, docs):
    none = labels(spark).where(F.lit(False))
    assert {r["score"] for r in quality.scored(docs, none).collect()} == {0.5}
    one = labels(spark).where("quality = 1")
    assert {r["predicted"] for r in quality.scored(docs, one).collect()} == {1}


def test_line_dedup_of_odd_texts(docs):
    rows = by_id(line_dedup.without_boilerplate(docs))
    assert rows[1]["text"] is None and rows[1]["n_lines"] == 0
    assert rows[2]["text"] == "" and rows[3]["text"] == " \n\t "
    assert rows[5]["n_lines"] == 2


def test_boilerplate_in_rows_without_id_or_site(spark):
    rows = [(k, "menu\nown %d" % k, f"s{k}") for k in range(6)]
    rows += [(None, "menu\nx", None), (None, "menu\nx", None), (9, "menu\n menu ", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = line_dedup.without_boilerplate(docs).collect()
    assert sorted(r["text"] for r in found) == sorted([f"own {k}" for k in range(6)] + ["x", "x", ""])


def test_mix_of_odd_texts(docs):
    rows = by_id(mixing.mix(docs).drop("row"))
    assert all(rows[i]["size"] == 0 and rows[i]["repeats"] == 0 for i in (1, 2, 3))
    assert rows[3]["source_size"] == rows[None]["source_size"] == 5  # no source is a source


def test_mix_without_words_takes_nothing(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r["repeats"] for r in mixing.mix(docs).collect()] == [0, 0]


def test_bpe_of_nothing(docs):
    rows = by_id(encoded(docs))
    assert rows[1]["n_tokens"] == rows[2]["n_tokens"] == 0
    assert bytes(rows[6]["decoded"]).decode() == LONG


def test_embeddings_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]),
        (10, [1e300, 1.0]), (11, [-1.0, 0.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {name: F.lit(1) for name in ("label", "uid", "unit", "size", "filter", "links", "root")}
    )
    found = embedding_dedup.near_duplicates(vectors).collect()
    told = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in found))
    assert told == [
        (0, 4, 7, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True),
        (5, 0, 5, True), (6, 0, 6, True), (7, 4, 7, True), (8, 4, 7, False), (8, 4, 7, False),
        (9, 0, 9, True), (10, 4, 7, False), (11, 0, 11, True),
    ]
    assert embedding_dedup.near_duplicates(vectors.where(F.lit(False))).collect() == []


def test_tables_of_the_test_data_have_what_the_queries_read(spark):
    assert {"doc_id", "text", "lang", "source"} <= set(table(spark, "/root/testdata/sf0.001", "documents").columns)
