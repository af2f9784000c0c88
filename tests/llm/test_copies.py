"""Exact copies, near copies, repeated passages and leaks, against brute force and at their edges."""

import re

import pytest

from tabloom.llm import decontaminate, minhash
from tabloom.llm.common import maybe_in, salted_join, written
from tabloom.llm.components import components
from tabloom.llm.exact_dedup import drop_copies, find_copies
from tabloom.llm.line_dedup import remove_repeats


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in frame.collect()}


# --- shared helpers ---


def test_salted_join_equals_a_plain_join(spark):
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 0, id % 50) AS k")
    groups = written(rows.groupBy("k").count().withColumnRenamed("count", "n"), "test")
    found = salted_join(rows, groups, ["k"], "n", rows["id"]).select("id", "k", "n")
    assert found.exceptAll(rows.join(groups, "k").select("id", "k", "n")).isEmpty() and found.count() == 3000


def test_filter_has_no_false_negatives(spark):
    members = written(spark.range(0, 2000, 7).withColumnRenamed("id", "k"), "test")
    rows = maybe_in(spark.range(2000).withColumnRenamed("id", "k"), members, ["k"])
    assert rows.count() == 2000
    assert rows.where("k % 7 = 0 AND NOT _maybe").isEmpty()
    assert rows.where("k % 7 <> 0 AND _maybe").count() < 200


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 130)] + [(203, 201), (201, 202), (202, 203)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(found[i] == 10 for i in range(10, 41))
    assert all(found[i] == 100 for i in range(100, 130))
    assert found[202] == found[203] == found[201] == 201
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


# --- exact ---


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_copies(docs, digest_all):
    long = "x" * 200
    table = docs((1, "Same"), (5, "sAME"), (3, None), (4, ""), (6, long + "a"), (7, long + "b"), (8, "É"), (9, "é"), (None, "same"))
    found = by_id(find_copies(table, digest_all=digest_all), "keep_id", "group_size", "kept")
    assert found == {1: (5, 2, False), 5: (5, 2, True), 3: (4, 2, False), 4: (4, 2, True), 6: (6, 1, True),
                     7: (7, 1, True), 8: (8, 1, True), 9: (9, 1, True)}
    assert find_copies(docs().limit(0), digest_all=digest_all).isEmpty()


def test_exact_stage_keeps_one_row_of_each_text(docs):
    table = docs((1, "a"), (1, "a"), (1, "b"), (2, "A"), (3, "b"), (4, "c"), (None, "a"), (None, "a"), (5, None), (6, ""))
    kept = drop_copies(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [
        (0, "a"), (0, "a"), (2, "A"), (3, "b"), (4, "c"), (6, "")]
    assert drop_copies(docs((1, "a"), (1, "a"))).count() == 1


# --- near ---


def shingle_set(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


def brute_components(pairs):
    sets = {i: shingle_set(t) for i, t in pairs}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low = min(label[a], label[b])
                    changed |= label[a] != low or label[b] != low
                    label[a] = label[b] = low
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def edited(text, places):
    words = text.split()
    for p in places:
        words[p] = f"edit{p}"
    return " ".join(words)


def test_near_groups_equal_brute_force(docs, text_of):
    base = text_of(1, 120)
    pairs = [(50, base)] + [(51 + i, edited(base, (10 * i % 110, 40 + i))) for i in range(25)]
    pairs += [(200 + i, text_of(100 + i, 60)) for i in range(20)]
    pairs += [(300, None), (301, ""), (302, " \t\n"), (303, "One two"), (304, "one  TWO"), (305, "one two three"), (306, "É a b c d"),
              (307, "é a b c d"), (308, "a " * 3000), (309, "a " * 2000)]
    found = minhash.near_groups(docs(*pairs, (None, base)))
    assert by_id(found, "n_shingles", "component_id", "kept") == brute_components(pairs)


def test_blocks_find_links_that_no_first_pair_had(docs, text_of, monkeypatch):
    """With one verified pair a document and blocks of four rows nothing is lost."""
    monkeypatch.setattr(minhash, "FIRST", 1)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    pairs = []
    for family in range(3):
        base = text_of(500 + family, 80)
        # a chain: neighbours are linked, the ends are not
        words = base.split()
        pairs += [(1000 * family + i, " ".join(words[:i] + [f"z{family}"] * 0 + words[i : i + 60])) for i in range(0, 20, 2)]
        pairs += [(1000 * family + 500 + i, edited(base, range(i, 80, 16))) for i in range(12)]
    assert by_id(minhash.near_groups(docs(*pairs)), "n_shingles", "component_id", "kept") == brute_components(pairs)


def test_least_matches_keep_the_true_share():
    from math import comb

    limits = minhash.least_matches()
    assert limits == sorted(limits) and len(limits) == 4
    # a pair at the threshold is pruned with a probability of about the chosen one at each step
    for n, least in zip(range(32, 129, 32), limits, strict=True):
        missed = sum(comb(n, m) * 0.75**m * 0.25 ** (n - m) for m in range(least))
        assert missed < 1e-4


def test_near_stage(docs, text_of):
    base = text_of(3, 100)
    table = docs((9, base), (4, edited(base, [50])), (7, "x"), (8, None), (None, base), (7, "x"))
    kept = minhash.drop_near_copies(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 7, 7, 8]
    assert minhash.near_groups(docs().limit(0)).isEmpty()


# --- lines ---


def test_repeated_chunks_go_and_first_ones_stay(docs, text_of):
    passage = "\n".join(text_of(70 + i, 9) for i in range(14))
    own = ["\n".join(text_of(1000 * k + i, 8) for i in range(6)) for k in range(4)]
    table = docs((1, own[0] + "\n" + passage), (2, own[1] + "\n" + passage + "\n" + own[2]), (3, own[3]), (4, None), (5, ""), (None, passage))
    found = by_id(remove_repeats(table), "text", "n_lines", "removed_lines")
    assert found[1] == (own[0] + "\n" + passage, 20, 0)
    text, lines, removed = found[2]
    assert lines == 26 and 6 <= removed <= 14
    assert all(line in text.split("\n") for line in (own[1] + "\n" + own[2]).split("\n"))
    assert found[3] == (own[3], 6, 0) and found[4] == (None, 0, 0) and found[5] == ("", 1, 0)
    assert found[None] == (passage, 0, 0)
    assert remove_repeats(table).columns == [*table.columns, "n_lines", "removed_lines"]
    assert remove_repeats(docs().limit(0)).isEmpty()


def test_rows_that_repeat_an_id_are_told_apart(docs, text_of):
    passage = "\n".join(text_of(90 + i, 9) for i in range(30))
    table = docs((1, passage), (1, "alone\n" + text_of(5, 4)), (2, passage))
    texts = sorted(r["text"] for r in remove_repeats(table).collect())
    assert passage in texts and "alone\n" + text_of(5, 4) in texts
    assert min(len(t) for t in texts) < len(passage)


# --- leaks ---


def similarity(window, item):
    size = min(5, len(item))
    own = [" ".join(window[i : i + size]) for i in range(len(window) - size + 1)]
    other = [" ".join(item[i : i + size]) for i in range(len(item) - size + 1)]
    common = sum(min(own.count(s), other.count(s)) for s in set(own))
    return common / (len(own) + len(other) - common)


def brute_leaks(pairs, items):
    split = lambda t: [w for w in re.split(r"[^\w]|_", (t or "").lower()) if w]
    out = set()
    for doc_id, text in pairs:
        words = split(text)
        for item_id, item in items:
            item = split(item)
            if not item:
                continue
            for at in range(-len(item) + 1, len(words)):
                window = words[max(at, 0) : at + len(item)]
                if len(window) >= min(5, len(item)) and similarity(window, item) >= 0.75:
                    out.add((doc_id, item_id))
    return out


def test_leaks_equal_brute_force(docs, spark, text_of):
    items = [(i, text_of(40 + i, 15 + 6 * i)) for i in range(8)] + [(20, "two Words"), (21, None), (22, " ... "), (23, text_of(47, 57))]
    pairs = [(i, text_of(900 + i, 30) + " " + items[i][1].upper().replace(" ", "!! ") + "\n" + text_of(950 + i, 30)) for i in range(8)]
    pairs += [(30 + i, text_of(800, 20) + " " + edited(items[i][1], [len(items[i][1].split()) // 2])) for i in range(8)]
    pairs += [(50 + i, edited(items[i][1], [0]) + " end") for i in range(8)]
    pairs += [(70, None), (71, ""), (72, "two words"), (73, "two  other words"), (74, text_of(40, 14))]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs(*pairs, (None, items[3][1])), table).collect()}
    assert found == brute_leaks(pairs, items)
    kept = decontaminate.drop_leaks(docs(*pairs, (None, items[3][1])), table)
    assert {r["doc_id"] for r in kept.collect()} == {None, *(p[0] for p in pairs)} - {d for d, _ in found}


def test_leaks_of_empty_tables(docs, spark, text_of):
    none = spark.createDataFrame([], "item_id long, text string")
    table = docs((1, text_of(1, 50)))
    assert decontaminate.leaked_items(table, none).collect()[0]["leaked"] is False
    assert decontaminate.drop_leaks(table, none).count() == 1
    some = spark.createDataFrame([(1, text_of(1, 30))], "item_id long, text string")
    assert decontaminate.leaked_items(docs().limit(0), some).isEmpty()


def test_near_masks_guarantee_the_radius():
    """Any two prints within the radius meet in a block with at most RADIUS // BLOCKS different bits."""
    import random

    masks = set(decontaminate._near_masks())
    width = decontaminate.BITS // decontaminate.BLOCKS
    draw = random.Random(1)
    for _ in range(2000):
        difference = sum(1 << b for b in draw.sample(range(decontaminate.BITS), decontaminate.RADIUS))
        blocks = [(difference >> (i * width)) & ((1 << width) - 1) for i in range(decontaminate.BLOCKS)]
        assert any(b in masks for b in blocks)
