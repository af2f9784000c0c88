"""Every repeated run of two lines or more goes, against brute force."""

import random

from tabloom.llm.line_dedup import remove_repeats


def brute_passages(texts):
    """(text, removed) of each id: lines of runs of 2 to 6 lines that occur before, by trying all runs at all places."""
    seen, out = set(), {}
    for doc_id, text in sorted(texts.items()):
        lines, gone = text.split("\n"), set()
        for at in range(len(lines)):
            for size in range(2, 7):
                run = tuple(lines[at : at + size])
                if len(run) == size and run in seen:
                    gone |= set(range(at, at + size))
            seen |= {tuple(lines[start : at + 2]) for start in range(max(at - 4, 0), at + 1) if at + 1 < len(lines)}
        out[doc_id] = ("\n".join(line for i, line in enumerate(lines) if i not in gone), len(gone))
    return out


def found_passages(frame):
    return {r["doc_id"]: (r["text"], r["removed_lines"]) for r in frame.collect()}


def test_short_passages_inside_documents_go(docs, text_of):
    """Passages of 2 to 16 lines between lines of the document's own; none is lost, whatever its length."""
    passages = {n: [text_of(100 * n + i, 9) for i in range(n)] for n in range(2, 17)}
    own = {k: [text_of(9000 + 10 * k + i, 8) for i in range(4)] for k in range(40)}
    rows = {1: "\n".join(line for n, p in passages.items() for line in [*p, f"between {n}"])}
    rows |= {n: "\n".join(own[n][:2] + p + own[n][2:]) for n, p in passages.items()}
    found = found_passages(remove_repeats(docs(*rows.items())))
    assert found[1] == (rows[1], 0)
    for n in passages:
        assert found[n] == ("\n".join(own[n]), n)


def test_passages_equal_brute_force(docs):
    draw = random.Random(3)
    texts = {i: "\n".join(draw.choice(["", *(f"line {k}" for k in range(14))]) for _ in range(draw.randrange(1, 14))) for i in range(60)}
    texts |= {100: "", 101: "\n", 102: "\n\n\n", 103: "a\na\na\na", 104: "a\na", 105: "é\r\nb\r", 106: "é\r\nb\r"}
    found = found_passages(remove_repeats(docs(*texts.items())))
    assert found == brute_passages(texts)
    kept = {line for text, _ in found.values() for line in text.split("\n")}
    assert kept >= {line for text in texts.values() for line in text.split("\n")}


def test_passages_of_odd_rows(docs):
    table = docs((1, "a\nb\nc"), (1, "x\na\nb"), (2, "a\nb"), (3, None), (None, "a\nb"))
    rows = remove_repeats(table)
    assert rows.columns == [*table.columns, "n_lines", "removed_lines"]
    found = sorted((r["doc_id"] or 0, r["text"] or "", r["n_lines"]) for r in rows.collect())
    assert found[0] == (0, "a\nb", 0) and found[-2:] == [(2, "", 2), (3, "", 0)]
    assert sorted(t for i, t, _ in found if i == 1) in (["a\nb\nc", "x"], ["c", "x\na\nb"])
    assert remove_repeats(docs().limit(0)).isEmpty()


def test_boundaries_move_only_next_to_a_change(docs, text_of):
    """A passage with one line put in or taken out goes but for that line, from texts it is shifted in."""
    passage = [text_of(300 + i, 9) for i in range(40)]
    put_in = ["head", *passage[:17], "put in", *passage[17:]]
    taken_out = ["other head", "and more", *passage[:20], *passage[21:]]
    found = found_passages(remove_repeats(docs((1, "\n".join(passage)), (2, "\n".join(put_in)), (3, "\n".join(taken_out)))))
    assert found == {1: ("\n".join(passage), 0), 2: ("head\nput in", 40), 3: ("other head\nand more", 39)}


def test_long_runs_of_equal_lines(docs):
    """200,000 blank lines: each pair is a chunk of its own, all with one first occurrence."""
    found = found_passages(remove_repeats(docs((1, "\n" * 200_000), (2, "a\n\n\nb"))))
    assert found == {1: ("", 200_000), 2: ("a\nb", 2)}


def test_many_texts_share_one_passage(docs, text_of):
    """A hot passage of different extents, and the columns of the caller with the names of helpers."""
    passage = [text_of(500 + i, 6) for i in range(12)]
    texts = {0: "\n".join(passage)}
    draw = random.Random(9)
    for i in range(1, 400):
        first = draw.randrange(10)
        texts[i] = "\n".join([f"own {i}", *passage[first : draw.randrange(first + 2, 13)], f"end {i}"])
    table = docs(*texts.items()).selectExpr("*", "1 AS __row", "2 AS __gone", "'m' AS __maybe", "3 AS __page", "4 AS n_lines")
    rows = remove_repeats(table)
    assert rows.columns == [*(c for c in table.columns if c != "n_lines"), "n_lines", "removed_lines"]
    assert {(r["__row"], r["__gone"], r["__maybe"], r["__page"], r["_row"]) for r in rows.collect()} == {(1, 2, "m", 3, "r")}
    found = found_passages(rows)
    assert all(found[i][0] == f"own {i}\nend {i}" for i in range(1, 400)) and found[0] == (texts[0], 0)
