"""Every query with an SQL statement gives the same rows as that statement; the others keep their contract."""

import binascii

import duckdb
import pytest

from tabloom.llm.queries import ORACLE, QUERIES

TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, folder, name):
    frame = QUERIES[name](spark, folder)
    cursor = duck.execute(ORACLE[name])
    names = sorted(frame.columns)
    described = [c[0] for c in cursor.description]
    assert sorted(described) == names
    order = [described.index(n) for n in names]
    expected = sorted(repr(tuple(row[i] for i in order)) for row in cursor.fetchall())
    actual = sorted(repr(tuple(row[n] for n in names)) for row in frame.collect())
    assert actual == expected
    assert actual


@pytest.mark.parametrize("name", ["op1_language_id", "op5_toxicity", "op8_quality"])
def test_scores_cover_every_document(spark, folder, name):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = QUERIES[name](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in documents.select("doc_id").collect())
    parts, held = (3, 1) if name.startswith("op1") else (5, 0)
    for r in rows:
        assert r["held_out"] == (binascii.crc32(str(r["doc_id"]).encode()) % parts == held)
        assert 0 <= r["score"] <= 1


def test_pipeline_packs_only_documents_it_kept(spark, folder):
    from tabloom.llm.common import read_table
    import corpus_pipeline

    docs = read_table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        assert kept.exceptAll(docs).isEmpty()
        docs = kept
    pieces = corpus_pipeline.run(spark, folder)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}
