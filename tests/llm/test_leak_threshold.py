"""Leaks just above the similarity threshold."""

from tabloom.llm import decontaminate


def test_passages_whose_last_words_differ_leak_up_to_the_threshold(docs, spark, text_of):
    """The last k words of each item differ, k as large as a similarity of 0.75 allows, at any fingerprint distance."""
    items, pairs = [], []
    for n, (size, changed) in enumerate([(18, 2), (25, 3), (40, 5), (46, 6), (53, 7), (59, 7), (100, 13)] * 12):
        words = [f"item{n}word{i}" for i in range(size)]
        items.append((n, " ".join(words)))
        window = words[: size - changed] + [f"other{n}word{i}" for i in range(changed)]
        pairs.append((n, f"{text_of(n, 10)} {' '.join(window)} {text_of(n + 500, 10)}"))
    table = spark.createDataFrame(items, "item_id long, text string")
    leaks = decontaminate.find_leaks(docs(*pairs), table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in leaks} == {(n, n) for n, _ in items}
    assert all(0.75 <= r["similarity"] < 0.8 for r in leaks)


def planted(text_of):
    """Thirty items, and documents that hold them with 0 to 2 words changed in the middle."""
    items = [(i, text_of(4000 + i, 45 + 2 * i, 4000)) for i in range(30)]
    pairs = []
    for i, item in items:
        for changed in range(3):
            words = item.split()
            for j in range(changed):
                words[20 + j] = f"other{j}"
            pairs.append((10 * i + changed, f"{text_of(7000 + i, 12)} {' '.join(words)} {text_of(8000 + i, 12)}"))
    return items, pairs


def test_fingerprints_propose_what_leaks(docs, spark, text_of, monkeypatch):
    """The search alone finds nearly all leaks; without it the near ones are lost, as the second source holds far ones only."""
    items, pairs = planted(text_of)
    table = spark.createDataFrame(items, "item_id long, text string")

    def leaks(**options):
        return {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs(*pairs), table, **options).collect()}

    every = leaks()
    assert every >= {(10 * i + changed, i) for i in range(30) for changed in range(2)}
    assert len(leaks(far=False)) >= 0.9 * len(every)
    search = decontaminate._near
    monkeypatch.setattr(decontaminate, "_near", lambda prints, benchmark: search(prints, benchmark).where("false"))
    assert len(leaks()) <= 0.1 * len(every)


def test_a_passage_that_most_documents_and_items_share(docs, spark, text_of):
    """A hot shingle on both sides, repeated ids of items and documents."""
    shared = text_of(77, 30, 4000)
    items = [(i, f"{shared} {text_of(600 + i, 40, 4000)}") for i in range(20)] + [(3, f"{shared} {text_of(603, 40, 4000)}"), (99, shared)]
    pairs = [(k, f"{text_of(k, 8)} {shared} {text_of(k + 999, 9)}") for k in range(300)]
    pairs += [(5, items[7][1]), (5, items[8][1]), (400, items[3][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs(*pairs), table).collect()}
    assert found == {(k, 99) for k in [*range(300), 400]} | {(5, 7), (5, 8), (400, 3)}
