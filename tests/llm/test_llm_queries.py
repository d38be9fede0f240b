"""The dealt queries on the smallest given tables, and every operator on awkward tables."""

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from tickloom.llm import (
    chat, decontaminate, html_text, language, licenses, mixing, quality_cnn, quality_rules, simhash, toxicity,
)
from tickloom.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(name, spark, sf_dir, duck):
    assert compare(QUERIES[name](spark, sf_dir), duck, SQL[name]) == []


COLUMNS = {
    "op1_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_quality_cnn": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_document(name, spark, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    assert {k: v for k, v in df.dtypes if k in COLUMNS[name]} == COLUMNS[name]
    rows, ids = df.agg(F.count("*"), F.count_distinct("doc_id")).first()
    assert rows == ids == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


DOCS = "doc_id long, text string, lang string, source string, n_chars long, ledger int, HITS int, quality_score int, copy int"
LONG = "alpha beta gamma delta " * 30_000
AWKWARD = [
    (1, None, None, None, None, 1, 1, 1, 1),
    (2, "", "en", "a", 0, 1, 1, 1, 1),
    (3, " \t\r\n\x0b\x0c", "en", "a", 6, 1, 1, 1, 1),
    (None, "some words without an id", "en", None, 24, 1, 1, 1, 1),
    (None, "some words without an id", "en", None, 24, 1, 1, 1, 1),
    (4, LONG, "de", "b", len(LONG), 1, 1, 1, 1),
    (5, "x" * 50_000, "de", "b", 50_000, 1, 1, 1, 1),
    (6, "the same text", "fr", "c", 13, 1, 1, 1, 1),
    (6, "the same text", "fr", "c", 13, 1, 1, 1, 1),
    (7, "ïdïot 😀 日本語   nbsp".encode("utf-16", "surrogatepass").decode("utf-16"), "ja", "c", 20, 1, 1, 1, 1),
]
LABELS = "doc_id long, quality int, toxic int"
BENCHMARK = "item_id long, text string"


@pytest.fixture(scope="module", params=["awkward", "empty"])
def docs(request, spark):
    return spark.createDataFrame(AWKWARD if request.param == "awkward" else [], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (2, 1, 0), (4, 1, None), (6, 0, 1), (6, 0, 1), (None, 1, 1), (7, None, 0), (99, 1, 0)], LABELS)


def test_rules_on_awkward_tables(docs):
    book = quality_rules.ledger(docs)
    assert book.columns == docs.columns  # the ledger replaces the column of its name
    rows = {(r.doc_id, r.text): r.ledger for r in book.collect()}
    if rows:
        assert rows[(1, None)].n_words == rows[(2, "")].n_words == rows[(3, AWKWARD[2][1])].n_words == 0
        assert rows[(4, LONG)].n_repeat_words == rows[(4, LONG)].n_words == 120_000
    assert quality_rules.ablations(book, [quality_rules.BASE]).count() in (0, 2)


def test_mixing_on_awkward_tables(docs):
    taken = mixing.taken(docs)
    assert taken.count() == docs.count()
    assert taken.where("copies > 3 OR copies < 0 OR copies IS NULL").count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copy_"]
    assert mixed.count() == taken.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]


def test_classifiers_on_awkward_tables(docs, labels):
    model = language.train(docs)
    found = {(r.doc_id, r.text): r.language for r in language.identify(docs, model).collect()}
    if found:
        assert found[(1, None)].lang == found[(2, "")].lang == "und" and found[(1, None)].score == 0
    for module in (quality_cnn, toxicity):
        scores = [r[-1] for r in module.score(docs, module.train(docs, labels), out="s").collect()]
        assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
        none = module.train(docs, labels.where("false"))
        assert all(r[-1] == 0.5 for r in module.score(docs, none, out="s").collect())


def test_simhash_on_awkward_tables(docs):
    rows = simhash.groups(docs).collect()
    assert len(rows) == docs.count()
    if rows:
        blank = [r for r in rows if r.fp == 0]
        assert {r.doc_id for r in blank} == {1, 2, 3} and {r.component_id for r in blank} == {1}
        assert [r.component_id for r in rows if r.doc_id is None] == [None, None]
    left = simhash.deduplicate(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(ids, key=str) == ([1, 4, 5, 6, 7, None] if rows else [])


def test_decontamination_on_awkward_tables(docs, spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "!!!"), (None, "some words without an id"), (5, "same text")], BENCHMARK)
    found = decontaminate.contaminated(docs, bench)
    got = sorted((str(r.doc_id), str(r.item_id)) for r in found.collect())
    assert got == ([("6", "5"), ("6", "5"), ("None", "None"), ("None", "None")] if docs.count() else [])
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0
    assert decontaminate.mark(docs, bench, out="HITS").columns == docs.columns


def test_licenses_on_awkward_tables(docs):
    rows = licenses.scan(docs).collect()
    assert len(rows) == docs.count() and all(r.n_base == 0 and r.first_word is None for r in rows)


def test_chat_on_awkward_tables(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 1, "assistant", "y"), (None, 1, "assistant", "y")],
        "conv_id long, turn long, role string, text string",
    ).withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(turns)).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 0 and got[None].n_turns == 2 and got[None].loss_chars == 2
    assert chat.digests(chat.format_chats(turns.where("false"))).count() == 0


def test_pages_on_awkward_tables(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (1, None, None), (None, "no url", "<p>a"), (2, "http://h/x", ""), (3, "http://h/y", "<" * 2000), (4, "http://h/z", "<div>" * 3000 + "deep")],
        "page_id long, url string, html string",
    ).withColumn("text", F.lit(5))
    got = [(r.page_id, r.text) for r in html_text.extract(pages).collect()]
    assert sorted(got, key=str) == sorted([(1, ""), (1, ""), (None, "a"), (2, ""), (3, "<" * 2000), (4, "deep")], key=str)
    assert html_text.extract(pages.where("false")).count() == 0
