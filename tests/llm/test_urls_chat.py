"""URL rules against a plain loop, and transcripts against exhaustive search."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import chat
from tabloom.llm.url_filter import judge_urls, rules_frame

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"), ("block", "b.org/fr/x"), ("block", "bare.io")]
URLS = [
    "http://a.example.net/en/1", "https://EXAMPLE.net/en", "http://example.net/EN/1", "http://xexample.com/de/1", "http://www.example.com/de/1?x=/fr/",
    "http://example.com/fr/#/de/", "http://b.org/fr/xyz", "http://a.b.org/fr/x", "http://c.org/fr/x", "net/", "://net/", "x://net", "x://net?a", "x://a..net/",
    "x://a.net:80/", "x://u@net/y", "", None, "http://bare.io", "http://sub.bare.io/any", "http://org/fr/", "://", "http:///path", "a://b://net/",
]


def judged(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in RULES:
        rule_host, slash, tail = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + tail):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, *(best or (None, "allow"))


@pytest.mark.parametrize("broadcast", [True, False])
def test_verdicts_equal_a_plain_loop(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("tabloom.llm.url_filter.MAX_BROADCAST_RULES", 0)
    rows = [(i, u, None, "r", "v") for i, u in enumerate(URLS)] + [(0, URLS[0], "<p>", "r", "v"), (None, URLS[0], None, "r", "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string, host string")
    found = judge_urls(pages, rules_frame(spark, [*RULES, ("allow", None)])).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(URLS[r["page_id"] or 0]), r
    assert judge_urls(pages.limit(0), rules_frame(spark, RULES)).isEmpty()
    assert judge_urls(pages, rules_frame(spark, RULES).limit(0)).where("verdict <> 'allow'").isEmpty()


# --- transcripts ---


@pytest.mark.parametrize("line, kind", [
    ("User: hi", "user"), ("[A] fine", "assistant"), ("**System** be kind", "system"), ("<|assistant|> x", "assistant"), ("Q: why?", "user"),
    ("Note: this", "unknown"), ("plain text", "none"), ("", "none"), ("http://x", "unknown"),
])
def test_markers(line, kind):
    assert chat.marker_of(line)[0] == kind


@pytest.fixture(scope="module")
def model(spark, folder):
    lines = chat.transcript_lines(spark.read.parquet(f"{folder}/conversations.parquet"))
    return chat.learn(lines)


def test_paths_equal_exhaustive_search(model):
    lines = ["System: be kind", "Q: why?", "more of it", "so", "A: because."]
    seen = model.emission(lines)

    def score(path):
        moves = [model.move[a, b] for a, b in zip([chat.START, *path], path)]
        return sum(moves) + sum(seen[i, s] for i, s in enumerate(path))

    best = max(itertools.product(range(chat.START), repeat=len(lines)), key=score)
    matrix = model.matrix(lines)
    assert matrix[chat.START].max() == pytest.approx(score(best))
    last = int(matrix[chat.START].argmax())
    assert model.states(lines, chat.START, last) == list(best)
    # two blocks give the matrix of the whole
    product = chat._product([model.matrix(lines[:2]).ravel(), model.matrix(lines[2:]).ravel()])
    assert np.allclose(product, matrix)


def test_roles_are_recovered_in_blocks_of_any_size(spark, folder, monkeypatch):
    conversations = spark.read.parquet(f"{folder}/conversations.parquet")
    lines = chat.transcript_lines(conversations)
    model = chat.learn(lines.where(F.crc32(F.col("conv_id").cast("string")) % 5 != 0))
    whole = chat.recover_turns(lines, model).collect()
    found = {}
    for r in whole:
        assert r["opens"] and r["rendered"].startswith(f"<|{r['role']}|>\n")
        found.setdefault(r["conv_id"], []).append((r["first_line"], r["last_line"], r["role"]))
    gold = lines.collect()
    right = [any(a <= r["position"] <= b and role == r["role"] for a, b, role in found[r["conv_id"]]) for r in gold]
    assert np.mean(right) > 0.9
    # blocks of one turn each, matrices multiplied two at a time: the same roles
    monkeypatch.setattr(chat, "RUN", 2)
    small = chat.recover_turns(lines.withColumn("block", F.floor(F.col("position") / chat.TURN_SPAN)), model).collect()
    roles = lambda rows: {(r["conv_id"], p["position"]): r["role"] for r in rows for p in gold
                          if p["conv_id"] == r["conv_id"] and r["first_line"] <= p["position"] <= r["last_line"]}
    assert roles(small) == roles(whole)
    assert sum(r["opens"] for r in small) == len(whole)


def test_odd_transcripts(spark):
    rows = [(1, 0, "user", None), (1, None, None, "x"), (None, 0, "user", "lost"), (2, 0, "robot", ""), (2, 0, "robot", ""), (3, 5, "user", "a\n\nb " * 2000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("line", F.lit("clash"))
    lines = chat.transcript_lines(table)
    assert lines.where("conv_id IS NULL").isEmpty()
    found = chat.recover_turns(lines, chat.learn(lines)).collect()
    assert {r["conv_id"] for r in found} == {1, 2, 3}
    assert chat.recover_turns(lines.limit(0), chat.learn(lines.limit(0))).isEmpty()


def test_rows_of_one_turn_stay_apart(spark, folder):
    model = chat.learn(chat.transcript_lines(spark.read.parquet(f"{folder}/conversations.parquet")))
    texts = ["m0 is here.\nm1 goes on.", "n0 is here.\nn1 goes on.", "n0 is here.\nn1 goes on."]
    rows = [(1, 0, "user", texts[0]), (1, 0, "user", texts[1]), (1, 0, "user", texts[2]), (1, None, "user", "first of all.\nand second.")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    lines = [r["line"] for r in chat.transcript_lines(table).orderBy("order").collect()]
    bodies = [line.split(": ", 1)[-1].split("] ")[-1].split("** ")[-1] for line in lines]
    assert bodies[:2] == ["first of all.", "and second."]
    assert sorted(zip(bodies[2::2], bodies[3::2], strict=True)) == sorted(tuple(t.split("\n")) for t in texts)
    found = chat.recover_turns(chat.transcript_lines(table), model).collect()
    assert sum(len(r["rendered"].split("\n")) - r["opens"] for r in found) == 8


def test_a_turn_of_more_lines_than_positions_keeps_their_order(spark, monkeypatch):
    """Lines beyond the positions of a turn, numbered downwards so that their texts sort the other way round."""
    monkeypatch.setattr(chat, "TURN_SPAN", 16)
    monkeypatch.setattr(chat, "BLOCK_SPAN", 64 * 16)
    text = "\n".join(f"{n:04d}" for n in range(2000, 0, -1))
    table = spark.createDataFrame([(1, 0, "user", text)], "conv_id long, turn int, role string, text string")
    lines = chat.transcript_lines(table)
    assert lines.where("position = 15").count() == 2000 - 15
    found = chat.recover_turns(lines, chat.learn(lines)).collect()
    assert len(found) == 1 and found[0]["rendered"].split("\n")[2:] == text.split("\n")[1:]
