"""Runs against a brute-force search over all starts and periods."""

import binascii
import hashlib
import random
import re

import numpy as np
import pytest

from tabloom.llm import periodic_runs as pr
from tabloom.llm.queries import QUERIES


def brute(words, least=12):
    """(start, length, period) of all runs."""
    n, found = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.add((i, j + q - i, q))
            i = j
    return sorted((s, m, q) for s, m, q in found if not any((s, m, p) in found for p in range(1, q)))


def collapsed(words, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found(texts):
    import pyarrow as pa

    batch = pr._piece(pa.array(range(len(texts))), pa.array(texts, pa.string()), 12).to_pylist()
    return [([(r["start"], r["length"], r["period"]) for r in row["runs"]], row["collapsed"]) for row in batch]


def check(texts):
    for text, (runs, rest) in zip(texts, found(texts), strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert runs == brute(words)
        assert rest == collapsed(words, runs)


def fibonacci(n):
    a, b = ["x"], ["x", "y"]
    while len(b) < n:
        a, b = b, b + a
    return " ".join(b[:n])


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_random_words(letters):
    draw = random.Random(letters)
    check([" ".join(draw.choice("abcde"[:letters]) for _ in range(draw.randrange(0, 120))) for _ in range(150)])


def test_planted_loops():
    draw = random.Random(5)
    texts = []
    for _ in range(80):
        parts = []
        for _ in range(draw.randrange(1, 5)):
            parts += [f"w{draw.randrange(40)}" for _ in range(draw.randrange(60))]
            loop = [f"w{draw.randrange(6)}" for _ in range(draw.randrange(1, 25))]
            parts += (loop * 9)[: draw.randrange(1, len(loop) * 9)]
        texts.append(" ".join(parts))
    check(texts)


def test_structured_words():
    thue = "".join("ab" if bin(i).count("1") % 2 else "ba" for i in range(200))
    check([fibonacci(400), " ".join(thue), " ".join("a" * 500), " ".join("ab" * 200 + "aab" * 100), " ".join("abcabd" * 40)])


def test_awkward_texts():
    check([None, "", "  \n\t", "one", "a b " * 20, "\x0bq\x0c" * 13, "é ü " * 9, "x " * 11, "x " * 12, "a\nb " * 6 + "a"])
    check([])


def test_every_derivation_position_spells_its_nonterminal():
    draw = np.random.default_rng(3)
    words = draw.integers(0, 4, 3000)
    firsts = np.array([0, 1000, 1000, 1001, 3000])
    grammar = pr.Grammar(words, firsts, 4)
    for position, owner in zip(grammar.position, grammar.owner, strict=True):
        low, high = grammar.low[owner], grammar.high[owner]
        assert (words[position : position + high - low] == words[low:high]).all()
    assert len(grammar.position) > len(grammar.low)


def test_no_pair_occurs_twice_in_what_is_left():
    words = np.random.default_rng(4).integers(0, 9, 4000)
    following = np.append(np.arange(1, 4000), -1)
    symbol = words.copy()
    grammar = pr.Grammar(words, np.array([0, 4000]), 1 << 40)
    alive, _ = grammar._replace_pairs(symbol, following)
    left = symbol[alive]
    pairs = list(zip(left, left[1:]))
    apart = [p for p in pairs if p[0] != p[1]]
    assert len(apart) == len(set(apart)) and len(left) < 4000


def test_long_text_in_bounded_time():
    (runs, rest), = found(["word " * 300_000])
    assert runs == [(0, 300_000, 1)] and rest == "word"


def looped(doc_id, words):
    h = binascii.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    words = looped(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, digest(listed), digest(collapsed(words, runs)))


def test_query_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    frame = QUERIES["op13_periodic_runs"](spark, folder)
    assert frame.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    actual = {r["doc_id"]: tuple(r) for r in frame.collect()}
    assert len(actual) == len(docs)
    for row in docs:
        if len(row["text"] or "") < 20_000:
            assert actual[row["doc_id"]] == expected(*row)


def test_rows_without_id_or_text(spark, docs):
    table = docs((None, "a b " * 8), (3, None), (3, ""), (7, "z " * 30), (7, "z " * 30), (10, " "))
    rows = pr.digest_runs(pr.find_runs(pr.with_loops(table))).collect()
    texts = [(None, "a b " * 8), (3, None), (3, ""), (7, "z " * 30), (7, "z " * 30), (10, " ")]
    assert sorted(map(repr, map(tuple, rows))) == sorted(repr(expected(*t)) for t in texts)
    assert pr.digest_runs(pr.find_runs(pr.with_loops(table.where("false")))).collect() == []
