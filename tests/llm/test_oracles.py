"""The contract queries against their SQL, over whole small tables."""

import os

import duckdb
import pytest

from lotgraph.llm import queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents benchmark labels pages conversations embeddings".split()


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    with duckdb.connect() as db:
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
        made = db.sql(queries.oracle_sql()[name])
        order = sorted(made.columns)
        want = sorted(repr([plain(r[made.columns.index(c)]) for c in order]) for r in made.fetchall())
    df = queries.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == order
    assert sorted(repr([plain(r[c]) for c in order]) for r in df.collect()) == want


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_language_query(spark):
    """What the contract asks of rows that SQL can't predict."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = queries.queries()["op2_language_id"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    known = {d.lang for d in docs.values() if d.lang is not None}
    assert {r.lang_pred for r in got} <= known | {"und"} and all(0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in docs[r.doc_id].text or "")) for r in got)
    held = [r for r in got if r.held_out and docs[r.doc_id].lang is not None and r.lang_pred != "und"]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.9 * len(held)
