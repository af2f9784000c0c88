"""The pipeline on awkward tables: empty, without ids, with repeated rows and clashing columns."""

import random

import pytest

import corpus_pipeline
from tabloom.llm.exact_dedup import find_copies
from tabloom.llm.minhash import near_groups

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, __page string, __digest string, __maybe int, __bits string, __kept string, __length int, key string"


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of labels and benchmark, and a function that makes documents."""
    spark.createDataFrame([(1, 0, 1), (2, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    item = " ".join(f"bench{i}" for i in range(20))
    spark.createDataFrame([(1, item), (2, None), (None, "x y z")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    def documents(*pairs):
        rows = [(i, t, None, None, None, "page", "digest", 1, "bits", "kept", 5, "k") for i, t in pairs]
        return spark.createDataFrame(rows, FIELDS)

    return str(tmp_path), documents, item


def through(spark, docs, folder):
    """The ids that each filtering stage keeps, and the packed pieces."""
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        docs = after.checkpoint()
        kept.append(sorted((r["doc_id"] for r in docs.collect()), key=repr))
    return kept, corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()


def test_empty_table(spark, tables):
    folder, documents, _ = tables
    kept, pieces = through(spark, documents((1, "x")).where("false"), folder)
    assert kept == [[], [], [], []] and pieces == []


def test_awkward_rows_and_columns(spark, tables):
    folder, documents, item = tables
    draw = random.Random(2)
    prose = " ".join(f"w{draw.randrange(300)}" for _ in range(60))
    docs = documents(
        (10, prose), (11, prose.upper()), (12, prose + " end"), (13, f"before {item} after"), (14, None), (15, ""),
        (None, prose), (None, None), (16, "short"), (16, "short"), (17, "other " * 30),
    )
    (toxic, exact, near, clean), pieces = through(spark, docs, folder)
    assert len(toxic) == 11  # nothing can be learnt from two labels of unlike rows: no document is rejected
    assert exact == sorted([11, 12, 13, 15, None, None, 16, 17], key=repr)
    assert near == sorted([11, 13, 15, None, None, 16, 17], key=repr)
    assert clean == sorted([11, 15, None, None, 16, 17], key=repr)
    assert sorted({repr(p["doc_id"]) for p in pieces}) == sorted({repr(i) for i in clean})


def test_whole_digests_only_for_rows_in_doubt(spark):
    draw = random.Random(3)
    heads = ["".join(draw.choice("ab") for _ in range(64)) for _ in range(60)]
    texts = [draw.choice(heads) + draw.choice("xyz") * draw.randrange(9) for _ in range(300)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = find_copies(table).collect()
    groups = {}
    for t in texts:
        groups.setdefault((len(t), t[:64]), []).append(t)
    doubt = {i for i, t in enumerate(texts) if len(groups[len(t), t[:64]]) > 1}
    assert {r["doc_id"] for r in found if r["text_sha256"]} == doubt
    assert 0 < len(doubt) < 300
    digests = {r["text_sha256"] for r in found if r["group_size"] > 1}
    assert len(digests) == sum(texts.count(t) > 1 for t in set(texts))


def test_repeated_ids_lose_no_link(spark):
    """Two documents under one id link what is near to either of them."""
    draw = random.Random(5)
    text = lambda: [f"w{draw.randrange(2000)}" for _ in range(80)]
    a, b, c = text(), text(), text()
    near = lambda words: " ".join([*words[:-2], "other", "end"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (7, " ".join(c)), (9, " ".join(c)), (9, near(b) + " x"), (20, " ".join(text()))]
    for parts in (1, 3, 7):
        table = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found = {(r["doc_id"], r["component_id"]) for r in near_groups(table).collect()}
        assert found == {(1, 1), (2, 1), (3, 1), (7, 1), (9, 1), (20, 20)}
