"""Packing against exhaustive search and the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tabloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def padding(length, longest):
    return 0 if length & (length - 1) == 0 else longest - length


def exhaustive(at, costs, longest):
    at, costs = [0, *at], [0.0, *costs]
    best = [0.0] + [float("inf")] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            if at[j] - at[i] <= longest:
                best[j] = min(best[j], best[i] + padding(at[j] - at[i], longest) + costs[j])
    return best[-1]


@pytest.mark.parametrize("seed", range(40))
def test_cuts_are_the_cheapest(seed, monkeypatch):
    monkeypatch.setattr(packing, "POWERS", 20)
    draw = random.Random(seed)
    longest = draw.choice([8, 16, 32])
    at = np.cumsum([draw.randint(1, longest) for _ in range(draw.randint(1, 60))]).tolist()
    costs = [draw.choice([0.0, 4.0, 64.0]) for _ in at]
    chosen, cost = packing.best_cuts(at, costs, longest)
    assert cost == pytest.approx(exhaustive(at, costs, longest))
    ends = [0, *(at[c] for c in chosen)]
    assert ends[-1] == at[-1] and all(0 < b - a <= longest for a, b in zip(ends, ends[1:]))
    assert cost == pytest.approx(sum(padding(b - a, longest) for a, b in zip(ends, ends[1:])) + sum(costs[c] for c in chosen))


TEXTS = [
    "it's don''t x.'s a!'re 'll", "İstanbul ΑΣ. ΣΑΣ ﬁ…”. é.", "foo'S bar'll.x \t\r\n a\x1cb\x85c\xa0d é.", "e\u0301t\u0301 .\u0301x a.\u0301",
    "<|endoftext|> hi<|startoftext|>", "a.<|ENDOFTEXT|>b", "x <|endoftext", "<|endoftext|>", "１２ 3a4.5 [x]_y_ ~~a~~", "", " ", "中文。句子！", "CIÓN. 🙂🙂 a🙂", "x" * 500, "a\u200bb \ufeffc",
]


def test_ids_are_those_of_the_tokenizer(tokenizer):
    encoder = packing.WordEncoder(PATH)
    draw = random.Random(1)
    alphabet = "abcXYZ éßñ'.,!?*#\n\t0129ς ǆ"
    texts = TEXTS + ["".join(draw.choice(alphabet) for _ in range(draw.randrange(200))) for _ in range(300)]
    found = list(encoder.encode(pa.array([*texts, None])))
    assert len(found) == len(texts) + 1 and len(found[-1]) == 0
    for text, ids in zip(texts, found):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert [i.tolist() for i in encoder.encode(pa.array(["q", *texts]).slice(1, 3))] == [i.tolist() for i in found[:3]]


def test_forgetting_words_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "MAX_KNOWN_WORDS", 3)
    encoder = packing.WordEncoder(PATH)
    for text in ["one two three four five", "six seven one", "two eight"]:
        assert next(encoder.encode(pa.array([text]))).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_id_lies_in_one_piece(docs, tokenizer, text_of, monkeypatch):
    pairs = [(i, ". ".join(text_of(10 * i + k, 9) for k in range(i % 7 * 20))) for i in range(60)]
    pairs += [(100, None), (101, ""), (102, "word " * 9000), (None, "no id")]
    rows = packing.pack_documents(docs(*pairs).coalesce(2)).collect()
    sequences, by_doc = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 2048
    for doc_id, text in pairs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            piece = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(piece.tobytes()))
            at += r["length"]
        assert at == len(ids)
    assert packing.pack_documents(docs().limit(0)).isEmpty()


def test_order_is_kept_and_padding_is_small(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet").coalesce(1)
    rows = packing.pack_documents(documents).collect()
    order = [r["doc_id"] for r in documents.select("doc_id").collect()]
    packed = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    seen = list(dict.fromkeys(r["doc_id"] for r in packed))
    assert seen == order
    lengths = {}
    for r in rows:
        lengths[r["sequence_id"]] = lengths.get(r["sequence_id"], 0) + r["length"]
    total = sum(lengths.values())
    assert sum(padding(n, 2048) for n in lengths.values()) < 0.03 * total
