"""Registered queries against their SQL, and whole-table properties where SQL can't tell."""

from __future__ import annotations

import random

import compare
import duckdb
import pytest

import corpus_pipeline
from cartwright.llm import queries

DATA_TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for name in DATA_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_oracle(spark, data, duck, name):
    assert compare.difference(queries.queries()[name](spark, data), duck, queries.oracle_sql()[name]) is None


def test_thirteen_operators():
    numbers = {int(name[2:].split("_")[0]) for name in queries.queries()}
    assert numbers == set(range(1, 14))


def test_pipeline_stages_take_effect(spark, data):
    docs = queries.table(spark, data, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.saved(stage(spark, docs, data), "test")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.count() <= docs.count()
        docs = out
    assert 0 < docs.count() < before
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert mixed.count() == docs.count()


def test_pipeline_over_no_documents(spark, data, make_docs):
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, data).count() == 0


def test_pipeline_over_odd_documents(spark, data, make_docs, odd):
    docs = make_docs(odd)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, data).count() <= len(odd)


def test_stages_keep_columns_of_any_name_and_the_right_rows(spark, data, make_docs):
    """Which rows are left of documents whose columns have the operators' own names."""
    words = [f"{a}{b}" for a in "bcdfghklmn" for b in ("alo", "ero", "ilo", "udo", "ani", "eta")]
    text = lambda k, n=60: " ".join(random.Random(k).choices(words, k=n))
    shared = "a line that stands in two texts\nand the line after it"
    rows = [(i, text(i)) for i in range(1, 20)]
    rows += [(20, "too short"), (21, None), (None, text(50)), (22, f"{text(22)}\n{shared}\n"), (23, f"{text(23)}\n{shared}\n")]
    rows += [(24, text(5) + " end")]
    item = queries.table(spark, data, "benchmark").filter("length(text) > 50").first().text
    rows += [(25, f"{text(25)} {item} {text(26)}")]
    docs = make_docs(rows)
    for name in ("leaking", "copies", "line_dedup", "others", "component_id", "kept", "bits", "digest", "class"):
        docs = docs.withColumn(name, queries.F.lit(name))
    ids, texts = {}, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, data), "named")
        assert all(row.leaking == "leaking" and row.line_dedup == "line_dedup" for row in docs.collect())
        ids[name] = {row.doc_id for row in docs.collect()}
        texts[name] = {row.doc_id: row.text for row in docs.collect()}
    everyone = {row[0] for row in rows}
    assert ids["quality rules"] == everyone - {20, 21}
    assert ids["line dedup"] == ids["quality rules"]
    assert shared in texts["line dedup"][22] and shared not in texts["line dedup"][23]
    assert ids["n-gram jaccard join"] == ids["line dedup"] - {24}
    assert ids["benchmark decontamination"] == ids["n-gram jaccard join"] - {25}
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert {row.doc_id for row in mixed.collect()} == ids["benchmark decontamination"]
