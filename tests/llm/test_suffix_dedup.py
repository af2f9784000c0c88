"""Removed bytes against a brute-force search over all strings of 50 bytes."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import suffix_dedup as sd
from tabloom.llm.queries import QUERIES

SPAN = 50


def brute(rows):
    """(doc_id, n_bytes, n_removed, spans, kept) of each row of (doc_id, text)."""
    least = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for at in range(len(t) - SPAN + 1 if i is not None else 0):
            w = t[at : at + SPAN]
            least[w] = min(least.get(w, i), i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for at in range(len(t) - SPAN + 1 if i is not None else 0):
            if least[t[at : at + SPAN]] < i:
                gone[at : at + SPAN] = b"\1" * SPAN
        spans, at = [], 0
        while at < len(t):
            end = at
            while end < len(t) and gone[end] == gone[at]:
                end += 1
            if gone[at]:
                spans.append((at, end - at))
            at = end
        out.append((i, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def shown(rows):
    return sorted(map(repr, rows))


def check(spark, rows, parts=3, **options):
    frame = spark.createDataFrame([(t, "x", i, 1) for i, t in rows], "text string, key string, doc_id long, chunk int").repartition(parts)
    found = sd.remove_repeated(frame, **options).collect()
    assert shown((r[0], r[1], r[2], [tuple(s) for s in r[3]], bytes(r[4])) for r in found) == shown(brute(rows))


def copied(seed, n, length=400):
    """Texts that share passages, copies and nothing."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(draw.randrange(5, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(draw.randrange(0, length // 8)))]
        for _ in range(draw.randrange(0, 3)):
            passage = draw.choice(passages)
            low = draw.randrange(0, len(passage) // 2)
            parts += [passage[low : low + draw.randrange(30, 200)], " ".join(word() for _ in range(draw.randrange(0, 20)))]
        rows.append((draw.randrange(3 * n), "".join(parts)))
    return rows + [(10 * n + i, t) for i, t in draw.sample(rows, n // 5)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    check(spark, copied(seed, 60))


def test_hot_contexts_go_window_by_window(spark):
    passage = "".join(random.Random(1).choice("abcdefgh ") for _ in range(160))
    rows = [(i, f"{i * 7919 % 1000:04d}" * 9 + passage + f"{i * 104729 % 9973:05d}" * 9) for i in range(40)]
    check(spark, rows + copied(9, 20), hot=2)


def test_awkward_texts(spark):
    long = "0123456789" * 5
    rows = [
        (None, long * 3), (1, None), (2, ""), (3, long), (3, long), (4, long), (5, long[:-1]), (6, long + "x"), (7, "é" * 60),
        (-8, "é" * 25), (9, "a" * 500), (10, "a" * 49), (11, "b" + "a" * 300 + "c"), (12, "\x00" * 60), (13, "y" + "\x00" * 60), (14, "ab" * 100),
        (15, "ba" * 40), (16, (long * 3)[7:]),
    ]
    check(spark, rows)
    check(spark, rows, parts=1)


def test_empty_table(spark):
    assert sd.remove_repeated(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_text(spark):
    draw = np.random.default_rng(2)
    text = bytes(draw.integers(97, 123, 6_000_000, dtype=np.uint8)).decode()
    rows = [(1, text[1_000_000:1_000_100]), (2, text), (3, text[2_999_000:3_001_000] + "end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r[0]: r for r in sd.remove_repeated(frame).collect()}
    assert [tuple(s) for s in found[2]["spans"]] == [(1_000_000, 100)] and found[2]["n_bytes"] == 6_000_000
    assert [tuple(s) for s in found[3]["spans"]] == [(0, 2000)] and bytes(found[3]["kept"]) == b"end"


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_merged_order_is_the_sorted_order(shards):
    draw = random.Random(shards)
    texts = [bytes(draw.choice(b"ab") for _ in range(draw.randrange(50, 81))) for _ in range(20)]
    texts += [t[5:] + b"ab" * 3 for t in texts[:8]]
    texts = [t for t in texts if len(t) >= SPAN]
    symbols = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8)
    size = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(size)
    number = np.repeat(np.arange(len(size)), size)
    offset = np.arange(len(symbols)) - (ends - size)[number]
    rest = ends[number] - np.arange(len(symbols))
    bounds = np.unique(np.concatenate([[0], ends[np.linspace(0, len(ends) - 1, shards + 1).astype(int)][1:]]))
    merged = sd.Merged(symbols, offset, rest, bounds)
    suffix = lambda p: bytes(symbols[p : p + rest[p]])[:SPAN]
    in_order = [suffix(p) for p in merged.place]
    assert in_order == sorted(in_order) and sorted(merged.place) == list(range(len(symbols)))
    same = [a == b for a, b in zip(in_order, in_order[1:])]
    assert same == (np.diff(merged.block) == 0).tolist()


def test_query_equals_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    expected = [(i, n, gone, len(spans), hashlib.sha256(kept).hexdigest()) for i, n, gone, spans, kept in brute(rows)]
    frame = QUERIES["op12_suffix_dedup"](spark, folder)
    assert frame.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert shown(map(tuple, frame.collect())) == shown(expected)
    assert frame.where(F.col("n_removed") > 0).count() > 0
