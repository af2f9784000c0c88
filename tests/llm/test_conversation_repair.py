"""Repaired conversations against an exhaustive search over all edits."""

import binascii
import functools
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tabloom.llm import conversation_repair as cr
from tabloom.llm.queries import QUERIES

PATTERN = re.compile(r"(s?(ua)+)?\Z")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def exhaustive(rows):
    """(cost, audit, turns): the least edit string of all the cheapest; rows are (initial-bearing role, text, fault)."""

    def add(cost, edit, turns, rest):
        return rest and (cost + rest[0], edit + rest[1], turns + rest[2])

    def trim(shape):
        # Beyond the first two letters only the last decides; impossible shapes stay impossible.
        if not re.match(r"s?(ua)*u?\Z", shape):
            return "!"
        return {"": "", "s": "s"}.get(shape, "ua" if shape.endswith("a") else "u")

    @functools.cache
    def with_inserts(at, shape, left):
        options = [best_here(at, shape)]
        if left:
            for new in ("user", "assistant"):
                options.append(add(3, "I", ((new, ""),), with_inserts(at, trim(shape + new[0]), left - 1)))
        return min((o for o in options if o), key=lambda o: o[:2], default=None)

    @functools.cache
    def best_here(at, shape):
        if shape == "!":
            return None
        found = [(0, "", ())] if at == len(rows) and PATTERN.match(shape) else []
        if at < len(rows):
            role, text, fault = rows[at]
            late = 3 if fault == "truncated" else 0
            found.append(add(4, "D", (), with_inserts(at + 1, shape, 3)))
            if fault not in ("blank", "duplicate"):
                found.append(add(late, "K", ((role, text),), with_inserts(at + 1, trim(shape + (role[:1] or "!")), 3)))
                for new in ("user", "assistant"):
                    found.append(add(3 + late, "R", ((new, text),), with_inserts(at + 1, trim(shape + new[0]), 3)))
        return min((f for f in found if f), key=lambda f: f[:2], default=None)

    return with_inserts(0, "", 3)


def expected(rows):
    """The row of one conversation; rows are (turn, role, text) in order, after damage."""
    seen, faulty = set(), []
    for _, role, text in rows:
        body = BLANK.findall(text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        faulty.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, repaired = exhaustive(tuple(faulty))
    initials = [r[:1] for _, r, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: sum(x[2] == f for x in faulty) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
    }


def in_order(rows):
    mark = lambda text: hashlib.md5((" " if text is None else text).encode()).hexdigest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", mark(r[2])))


def filled(rows):
    return [(t, " " if r is None else r, " " if x is None else x) for t, r, x in in_order(rows)]


def draw_rows(seed, n):
    draw = random.Random(seed)
    roles = ("user", "assistant", "system", "tool", "user", "assistant", "", "Assistant", None)
    texts = ("Yes.", "No", "", " \t", "Why?", "é.", "So. ", None, "a:b\nc.")
    return [
        (draw.choice([None, *range(5)]) if draw.random() < 0.2 else i, draw.choice(roles), draw.choice(texts) if draw.random() < 0.5 else f"t{i}.")
        for i in range(n)
    ]


def check(spark, conversations):
    fields = "text string, conv_id long, turn long, role string, part string, symbols int"
    rows = [(x, c, t, r, "p", 1) for c, turns in conversations.items() for t, r, x in turns]
    found = cr.summarize(cr.repair(spark.createDataFrame(rows, fields))).collect()
    assert sorted((r["conv_id"] is not None, r["conv_id"] or 0) for r in found) == sorted((c is not None, c or 0) for c in conversations)
    for r in found:
        actual = r.asDict()
        assert (actual.pop("conv_id"), actual) == (r["conv_id"], expected(filled(conversations[r["conv_id"]])))


def test_equals_exhaustive_search(spark):
    conversations = {seed: draw_rows(seed, seed % 9 + 1) for seed in range(120)}
    conversations[None] = draw_rows(999, 5)
    check(spark, conversations)


def test_divided_conversations(spark, monkeypatch):
    monkeypatch.setattr(cr, "RUN", 2)
    conversations = {1: draw_rows(5, 40), 2: draw_rows(6, 3), 3: draw_rows(7, 33), None: draw_rows(8, 20)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, conversations)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_products_of_segments(size):
    draw = random.Random(size)
    for _ in range(60):
        symbols = "".join(draw.choice("suaxSUAXbd") for _ in range(draw.randrange(1, 30)))
        cuts = [symbols[i : i + size] for i in range(0, len(symbols), size)]
        matrices = [cr._matrix(c) for c in cuts]
        whole = matrices[0]
        for m in matrices[1:]:
            whole = cr._product(whole, m)
        costs, ranks = cr._rows(whole)[cr.START]
        last = cr._finish(costs, ranks)
        states = cr._crossings(matrices, cr.START, last)
        edits = "".join(cr.least_edits(c, a, b) for c, a, b in zip(cuts, [cr.START, *states], states)) + cr._END[last][1]
        assert (costs[last] + cr._END[last][0], edits) == cr.solve(symbols)


def test_long_conversation_over_many_tasks(spark):
    n = 9000
    rows = [(i, ("user", "assistant")[i % 2], f"line {i}." if i % 50 else "same.") for i in range(n)]
    frame = spark.createDataFrame([(1, *r) for r in rows], "conv_id long, turn long, role string, text string")
    (row,) = cr.summarize(cr.repair(frame)).collect()
    repeated = n // 50 - 1
    assert (row["duplicate"], row["illegal"], row["gaps"]) == (repeated, 0, 0)
    symbols = "".join("d" if i % 50 == 0 and i else "ua"[i % 2] for i in range(n))
    assert (row["cost"], row["audit"]) == cr.solve(symbols)
    turns = cr.apply_edits(row["audit"], cr.START, [r[1] for r in rows], [r[2] for r in rows])
    digest = hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()).hexdigest()
    assert row["repaired_sha256"] == digest


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.summarize(cr.repair(empty)).collect() == []
    assert cr.summarize(cr.repair(cr.damage(empty), F.col("present"))).collect() == []


def damaged(rows):
    out = []
    for conversation, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conversation, turn))
        code = binascii.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conversation, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def test_query_on_the_test_table(spark, folder):
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by_id = {r[0]: [] for r in table}
    for conversation, turn, role, text in damaged(table):
        by_id[conversation].append((turn, role, text))
    found = {r["conv_id"]: r.asDict() for r in QUERIES["op11_conversation_repair"](spark, folder).collect()}
    assert found.keys() == by_id.keys()
    for conversation, rows in by_id.items():
        actual = found[conversation]
        del actual["conv_id"]
        assert actual == expected(filled(rows)), conversation


def test_damage_of_nulls(spark):
    rows = [(None, None, None, None), (None, 3, "user", None), (5, None, None, "a."), (7, 1, "system", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept = cr.damage(frame).where("present").select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, damaged(rows)))
    assert len(cr.summarize(cr.repair(cr.damage(frame), F.col("present"))).collect()) == 3
