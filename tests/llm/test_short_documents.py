"""Near copies in tables and partitions that hold one very short document."""

import pytest

from tabloom.llm import minhash


@pytest.mark.parametrize("words", range(1, 6))
def test_tables_of_one_short_document(docs, words):
    text = " ".join("abcde"[:words])
    assert [tuple(r) for r in minhash.near_groups(docs((1, text))).collect()] == [(1, 1, 1, True)]


def test_one_short_document_in_each_partition(docs):
    rows = [(10 * n + twice, " ".join("vwxyz"[:n])) for n in range(1, 6) for twice in (0, 1)]
    table = docs(*rows).repartitionByRange(len(rows), "doc_id")
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_groups(table).collect()}
    assert found == {(10 * n + twice, 1, 10 * n, not twice) for n in range(1, 6) for twice in (0, 1)}
