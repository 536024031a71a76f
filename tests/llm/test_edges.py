"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

from __future__ import annotations

import ast
import pathlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import ROOT, SMALL
from salesmart.llm import chat, ctw, fingerprints, langid, mixing, near_dup, packing, quality, queries, sharding, url_filter
from salesmart.storage import Scratch

LONG = "lorem ipsum dolor sit amet " * 20_000
ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (None, "some words without an id here", "en", "a"), (3, " \n\t ", "en", None),
    (4, "same text twice over", "en", "b"), (5, "same text twice over", None, "b"), (6, "repeated row of words", "en", "b"),
    (6, "repeated row of words", "en", "b"), (7, LONG, "en", "a"), (8, "x", "fr", "a"), (9, "12345 !!", "en", "c"),
    (10, "Nous avons été là, déjà vu, où ça? " * 12, "fr", "c"), (11, "\U0001f600 emoji ünï", "en", "c"), (None, None, None, None),
]
CLASHING = ["size", "hash", "copies", "target", "taken", "score", "lang_pred", "kept", "shard", "slot", "key", "n", "_row", "_document",
            "source_id", "n_words", "_text_key", "_taken", "class_id", "fingerprint", "_folded", "_letters", "units", "_key0", "bucket"]


@pytest.fixture(scope="module")
def edges(spark):
    made = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    made = made.withColumn("n_chars", F.length("text").cast("long"))
    return made.withColumns({name: F.lit(i) for i, name in enumerate(CLASHING)})


OPERATORS = {
    "mixing": lambda df, s: mixing.mix(df, s),
    "near_dup": lambda df, s: near_dup.near_duplicates(df, s),
    "fingerprints": lambda df, s: fingerprints.edited_fingerprints(df),
    "ctw": lambda df, s: ctw.scored(df, s, ~ctw.held_out(F.col("doc_id"))),
    "packing": lambda df, s: packing.pack(df, queries.tokenizer_json(), s),
    "language": lambda df, s: langid.identify(df),
    "quality": lambda df, s: quality.assess(df, s),
    "sharding": lambda df, s: sharding.place(df, s),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows(spark, edges, scratch, name):
    rows = OPERATORS[name](edges, scratch).collect()
    if name == "packing":
        assert sum(row.start == 0 for row in rows) == len(ROWS)
    else:
        assert len(rows) == len(ROWS)
    by_id = {row.doc_id: row for row in rows}
    assert set(by_id) == {row[0] for row in ROWS}
    if name == "mixing":
        assert by_id[1].size == by_id[2].size == by_id[3].size == 0 and by_id[7].size == 100_000
        assert len({row.taken for row in rows if row.doc_id == 6}) == 1
    elif name == "near_dup":
        assert by_id[4].class_id == by_id[5].class_id == 4 and by_id[1].class_id == by_id[2].class_id == 1
        assert [row.kept for row in rows if row.doc_id == 6].count(True) == 1
        assert by_id[3].class_id == 3
    elif name == "fingerprints":
        assert by_id[1].fingerprint == by_id[2].fingerprint == "" and by_id[4].fingerprint == by_id[5].fingerprint != ""
        assert by_id[2].near_edited == 1.0
    elif name == "ctw":
        assert by_id[1].n_tokens == by_id[2].n_tokens == 1 and all(row.score < 0 for row in rows)
    elif name == "packing":
        assert by_id[1].doc_tokens == by_id[2].doc_tokens == 1
    elif name == "language":
        assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3, 9))
        assert by_id[10].lang_pred == "fr" and by_id[7].lang_pred == "en"
    elif name == "quality":
        assert by_id[1].n_words == 0 and by_id[1].base_failed and by_id[7].n_repeat_words == 100_000
    elif name == "sharding":
        assert by_id[1].size == 8 and len({row.shard for row in rows if row.doc_id is None}) == 1


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, edges, scratch, name):
    assert OPERATORS[name](edges.limit(0), scratch).collect() == []


def test_url_filter_edges(spark, scratch):
    made = spark.createDataFrame([(1, None, None), (2, "", ""), (None, "http://a.net/", "<a href=//b.net>" * 5_000), (3, "x://h", None), (3, "x://h", None)], "page_id long, url string, html string")
    made = made.withColumns({name: F.lit(1) for name in ("host", "path", "rule", "verdict", "trust", "src", "weight")})
    assert url_filter.judge(made, scratch).count() == 5
    assert url_filter.judge(made.limit(0), Scratch(spark, "none")).count() == 0


def test_chat_edges(spark):
    made = spark.createDataFrame([(1, 0, None, None), (1, 0, "assistant", "x"), (None, None, "user", "y"), (2, 5, "user", ""), (2, 5, "user", "")], "conv_id long, turn long, role string, text string")
    made = made.withColumns({name: F.lit(1) for name in ("formatted", "loss_start", "n_turns")})
    got = {row.conv_id: row for row in chat.read_back(chat.format_turns(chat.canonical_turns(made))).collect()}
    assert {conv: row.n_turns for conv, row in got.items()} == {1: 2, None: 1, 2: 2} and got[1].loss_chars == 1
    assert chat.read_back(chat.format_turns(chat.canonical_turns(made.limit(0)))).count() == 0


def test_stages_keep_columns_and_rows(spark, edges):
    docs, before = edges, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = Scratch(spark, "stages").table(stage(spark, docs, SMALL), name)
        assert docs.columns == edges.columns
        ids = {row.doc_id for row in docs.select("doc_id").collect()}
        assert before is None or ids <= before
        before = ids
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_dedup", "mixing", "packing"]


def test_stages_pass_an_empty_table_on(spark, edges):
    docs = edges.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = Scratch(spark, "stages").table(stage(spark, docs, SMALL), name)
        assert docs.count() == 0


def test_pipeline_equals_its_operators(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = {row.doc_id for row in langid.identify(docs).where("lang_pred != 'und' and score >= 0.5").collect()}
    good = {row.doc_id for row in quality.assess(docs.where(F.col("doc_id").isin(known)), Scratch(spark, "x")).where("kept").collect()}
    left = docs.where(F.col("doc_id").isin(good))
    one = {row.doc_id for row in near_dup.near_duplicates(left, Scratch(spark, "x")).where("kept").collect()}
    left = docs.where(F.col("doc_id").isin(one))
    taken = {row.doc_id: row.copies for row in mixing.mix(left, Scratch(spark, "x")).collect() if row.copies}
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    starts = [row.doc_id for row in pieces if row.start == 0]
    assert {i: starts.count(i) for i in set(starts)} == taken


def test_nothing_else_imports_the_operators():
    for path in [*pathlib.Path(ROOT, "salesmart").rglob("*.py"), *pathlib.Path(ROOT).glob("*.py")]:
        inside = "llm" in path.parts or path.name in ("corpus_pipeline.py", "__spark_entry__.py")
        if not inside:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
                assert not any("llm" in name or "corpus_pipeline" in name for name in names), path
