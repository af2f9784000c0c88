"""Trained scorers: gradients, calibration, held-out accuracy, edge cases."""

import binascii
import random

import numpy as np
import pytest

from tabloom.llm import language_id, quality, toxicity
from tabloom.llm.labels import labelled_sample
from tabloom.llm.queries import QUERIES

ODD = [(1, None), (2, ""), (3, "12 34 !?"), (4, "x" * 100_000), (5, "É"), (None, "some words here"), (2, "")]


def rank_auc(scores, labels):
    ones, zeros = [s for s, y in zip(scores, labels) if y == 1], [s for s, y in zip(scores, labels) if y == 0]
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


# --- language ---


def test_backpropagation_equals_differences():
    draw = np.random.default_rng(0)
    h = language_id.STATES
    net = language_id.Network(["a", "b"], draw.normal(0, 0.5, (2, 3 * h, 256)), draw.normal(0, 0.5, (2, 3 * h, h)),
                              draw.normal(0, 0.5, (2, 2, h)), np.zeros((2, 1)))
    data, held, owner = language_id._windows(["hello wörld, once more".encode(), b"abc " * 30])
    label = np.array([0, 1])[owner]
    _, grads = language_id._gradients(net, data, held, label)
    for weights, grad in zip(net.weights(), grads):
        for place in (np.unravel_index(np.abs(grad).argmax(), grad.shape), np.unravel_index(7 % grad.size, grad.shape)):
            keep = weights[place]
            losses = []
            for step in (1e-3, -1e-3):
                weights[place] = keep + step
                losses.append(language_id._gradients(net, data, held, label)[0])
            weights[place] = keep
            assert grad[place] == pytest.approx((losses[0] - losses[1]) / 2e-3, rel=0.05, abs=1e-4)


def test_every_position_is_labelled_and_pooled():
    draw = random.Random(3)
    words = {"x": ["the", "of", "and", "with"], "y": ["der", "und", "nicht", "ein"]}
    texts = [(" ".join(draw.choice(words[k]) for _ in range(60)), k) for k in "xy" * 60]
    net = language_id.train([t for t, _ in texts], [k for _, k in texts], epochs=2)
    text = "the und " * 40 + "é"
    labelled = language_id.label_positions(net, text)
    assert labelled.shape == (len(text.encode()), 2) and np.allclose(labelled.sum(axis=1), 1, atol=1e-5)
    assert np.allclose(labelled.mean(axis=0), language_id.pooled(net, [text.encode()])[0], atol=1e-5)
    assert language_id.pooled(net, [b"the of and " * 20])[0].argmax() == 0


def test_languages_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op1_language_id"](spark, folder).collect() if r["held_out"]]
    assert len(rows) > 200
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) > 0.95


def test_odd_texts_get_a_language(docs, spark):
    found = [r for r in language_id.identify(docs(*ODD)).collect()]
    assert len(found) == len(ODD) and all(r["lang_pred"] == "und" and r["score"] == 0 for r in found)
    table = docs(*ODD, *((i, "the of and") for i in range(10, 30)), *((i, "der und nicht") for i in range(40, 60)))
    table = table.selectExpr("text", "CASE WHEN text LIKE 'the%' THEN 'en' WHEN text LIKE 'der%' THEN 'de' END AS lang", "doc_id", "source")
    found = {(r["doc_id"], r["lang_pred"], r["held_out"]) for r in language_id.identify(table).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= {f[:2] for f in found}
    assert {f[1] for f in found} == {"und", "en", "de"} and (None, True) in {(f[0], f[2]) for f in found}
    assert language_id.identify(docs().limit(0)).isEmpty()


# --- toxicity ---


def test_isotonic_map_is_the_best_monotone_one():
    draw = np.random.default_rng(2)
    raw = draw.integers(0, 12, 200).astype(float)
    y = (draw.random(200) < raw / 15).astype(float)
    fitted = toxicity.isotonic(raw, y)
    values = fitted(np.arange(12.0))
    assert (np.diff(values) >= -1e-12).all()
    # min-max formula of the isotonic regression
    levels = np.unique(raw)
    means = lambda i, j: y[(raw >= levels[i]) & (raw <= levels[j])].mean()
    for k in range(len(levels)):
        best = max(min(means(i, j) for j in range(k, len(levels))) for i in range(k + 1))
        assert fitted(levels[k : k + 1])[0] == pytest.approx(best)


def test_first_split_is_the_best_of_all(monkeypatch):
    monkeypatch.setattr(toxicity, "TREES", 1)
    monkeypatch.setattr(toxicity, "DEPTH", 1)
    draw = np.random.default_rng(4)
    x = draw.integers(0, 8, (300, 4)).astype(float)
    y = ((x[:, 2] > 4) ^ (draw.random(300) < 0.1)).astype(float)
    forest = toxicity.grow(x, y)
    p = (y.sum() + 0.5) / (len(y) + 1)
    g, h = y - p, np.full(len(y), p * (1 - p))

    def gain(f, t):
        right = x[:, f] > t
        return sum(g[s].sum() ** 2 / (h[s].sum() + toxicity.RIDGE) for s in (right, ~right))

    best = max(((gain(f, t), f) for f in range(4) for t in range(8)))
    assert forest.feature[0, 0] == best[1] == 2
    assert gain(2, forest.threshold[0, 0]) == pytest.approx(best[0])


@pytest.mark.parametrize("name, label, least", [("op5_toxicity", "toxic", 0.9), ("op8_quality", "quality", 0.9)])
def test_held_out_documents_are_ranked(spark, name, label, least):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    assert rank_auc([r["score"] for r in rows], [labels[r["doc_id"]] for r in rows]) > least


@pytest.mark.parametrize("score, label", [(toxicity.score_toxicity, "toxic"), (quality.score_quality, "quality")])
def test_odd_texts_get_scores(docs, spark, score, label):
    clean = [(i, f"a calm text number {i} with words") for i in range(10, 110)]
    bad = [(i, f"you vile wretch number {i} $$$") for i in range(200, 300)]
    table = docs(*ODD, *clean, *bad)
    marks = [(i, int((i >= 200) == (label == "toxic"))) for i, _ in clean + bad] + [(None, 1), (7777, 1), (10, None)]
    labels = spark.createDataFrame(marks, f"doc_id long, {label} int").withColumnRenamed("x", "y")
    rows = score(table, labels).collect()
    assert len(rows) == len(ODD) + 200
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["held_out"] == (r["doc_id"] is None or binascii.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in rows if r["held_out"] and (r["doc_id"] or 0) >= 10]
    assert rank_auc([r["score"] for r in held], [dict(marks)[r["doc_id"]] or 0 for r in held if True]) > 0.9
    for labels in (labels.limit(0), labels.where(f"{label} = 1")):
        assert score(table, labels).count() == len(ODD) + 200
    assert score(docs().limit(0), labels).isEmpty()


def test_toxicity_stage_keeps_columns(docs, spark):
    clean = [(i, f"a calm text number {i} with words") for i in range(10, 110)]
    bad = [(i, f"you vile wretch number {i} of them") for i in range(200, 300)]
    labels = spark.createDataFrame([(i, int(i >= 200)) for i, _ in clean + bad], "doc_id long, toxic int")
    table = docs(*clean, *bad, (None, "calm text"), (1, None))
    kept = toxicity.drop_toxic(table, labels)
    assert kept.columns == table.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {i for i, _ in clean} | {None, 1} <= ids and len(ids & {i for i, _ in bad}) <= 5


# --- subwords ---


def test_subwords_equal_a_plain_loop():
    texts = ["ab cde  f", "", "gg gg hh", " x", "é ñandú\n\tzz"]
    buckets, owner = quality.subwords(texts)
    for i, text in enumerate(texts):
        words = text.split()
        grams = sum(max(len(w) + 2 - n + 1, 0) for w in words for n in quality.NGRAMS)
        same = sum(a == b for a, b in zip(words, words[1:]))
        assert (owner == i).sum() == len(words) + grams + same
        # the same words in another text have the same buckets
        alone, _ = quality.subwords([text])
        assert sorted(alone) == sorted(buckets[owner == i])


def test_pieces_of_a_long_text_count_like_the_whole(monkeypatch):
    draw = random.Random(4)
    text = "".join(draw.choice("ab cd é\n\t") for _ in range(3000)) + " same same" * 30
    whole, _ = quality.subwords([text])
    for size in (7, 50, 1 << 19):
        monkeypatch.setattr(quality, "PIECE_CHARS", size)
        held, times = quality.counts(text)
        assert np.repeat(held, times).tolist() == sorted(whole.tolist())
    monkeypatch.setattr(quality, "PIECE_CHARS", 100)
    model = quality.train([quality.counts(t) for t in ("good text", "bad stuff")], np.array([1, 0]))
    cut = model.probabilities([text, "x", ""])
    monkeypatch.setattr(quality, "PIECE_CHARS", 1 << 19)
    assert cut == pytest.approx(model.probabilities([text, "x", ""]))


def test_one_step_of_gradient_descent_equals_a_plain_loop():
    """Averages, softmax and one update of every vector, of the layer and of the bias."""
    texts, labels = ["ab ab cd", "ef gh", "ab ef"], np.array([1, 0, 1])
    documents = [quality.counts(t) for t in texts]
    untouched = quality.train([], labels)
    model = quality.train(documents, labels, epochs=1)
    vectors = untouched.vectors.astype(float)
    change = np.zeros_like(vectors)
    layer, bias = np.zeros((quality.VECTOR, 2)), np.zeros(2)
    for (held, times), label in zip(documents, labels):
        flat = np.repeat(held, times)
        mean = vectors[flat].mean(axis=0)
        error = np.full(2, 0.5)  # the softmax of two zeros
        error[label] -= 1
        layer -= quality.RATE * np.outer(mean, error) / 3
        bias -= quality.RATE * error / 3
        for b in flat:
            change[b] += quality.RATE * quality.GAIN * (error @ np.zeros((2, quality.VECTOR))) / len(flat)
    assert model.layer == pytest.approx(layer, abs=1e-6) and model.bias == pytest.approx(bias, abs=1e-6)
    assert model.vectors == pytest.approx(vectors - change, abs=1e-6)
    margin = [np.mean([model.vectors[b] @ model.layer for b in quality.subwords([t])[0]], axis=0) + model.bias for t in texts]
    assert model.probabilities(texts) == pytest.approx([np.exp(m[1]) / np.exp(m).sum() for m in margin], abs=1e-6)


def test_quality_cue_outside_any_short_excerpt_is_learnt(docs, spark):
    """The cue stands behind the first thousand characters."""
    draw = random.Random(8)
    filler = lambda: " ".join(draw.choice(["lorem", "ipsum", "dolor", "amet"]) for _ in range(200))
    rows = [(i, f"{filler()} {'excellent work ' * 12 if i % 2 else 'zzqj kkw ' * 12}") for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    held = [r for r in quality.score_quality(docs(*rows), labels).collect() if r["held_out"]]
    assert rank_auc([r["score"] for r in held], [r["doc_id"] % 2 for r in held]) > 0.95


def test_labelled_sample_is_bounded_in_rows(docs, spark):
    table = docs(*[(1, f"text {i}") for i in range(50)], *[(i, "other") for i in range(2, 40)])
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(1, 0)], "doc_id long, quality int")
    for limit in (2, 100):
        rows = labelled_sample(table, labels, "quality", limit, id_col="doc_id", text_col="text").collect()
        assert len(rows) == len({r["id"] for r in rows}) <= limit


def test_every_language_is_sampled(spark):
    """101 languages of one letter each."""
    letters = [chr(0x4E00 + 50 * i) for i in range(101)]
    rows = [(f"{c * 3} {c * 4} " * 20, f"l{k:03d}", 1000 * k + j) for k, c in enumerate(letters) for j in range(6)]
    table = spark.createDataFrame(rows, "text string, lang string, doc_id long")
    texts, languages = language_id.training_sample(table, id_col="doc_id", text_col="text", lang_col="lang")
    assert len(set(languages)) == 101
    assert all(languages.count(name) <= 6 * language_id.EXCERPTS for name in set(languages))


def plain_step(net, d, byte, state, soft):
    h = language_id.STATES
    gates, own = net.inputs[d][:, byte], net.recurrent[d] @ state
    update, reset = (0.5 * soft(gates[k : k + h] + own[k : k + h]) + 0.5 for k in (0, h))
    candidate = soft(gates[2 * h :] + reset * own[2 * h :])
    return (state - candidate) * update + candidate


def test_network_equals_a_plain_loop():
    """The gates of both directions byte by byte, and the pooled probabilities."""
    texts = ["hola que tal", "the cat sat", "x"]
    net = language_id.train(["abc " * 9, "xyz " * 9], ["a", "b"], epochs=1)
    soft = lambda x: x / (1 + abs(x))
    for text in texts:
        data = text.encode()
        padded = data + bytes(language_id.WINDOW - len(data))
        states = []
        for d in (0, 1):
            order = range(len(padded)) if d == 0 else range(len(padded) - 1, -1, -1)
            state, kept = np.zeros(language_id.STATES), {}
            for i in order:
                state = plain_step(net, d, padded[i], state, soft)
                kept[i] = state
            states.append(kept)
        found = []
        for i in range(len(data)):
            scores = sum(net.output[d] @ states[d][i] for d in (0, 1)) + net.bias[:, 0]
            found.append(np.exp(scores) / np.exp(scores).sum())
        assert language_id.label_positions(net, text) == pytest.approx(np.array(found), abs=1e-4)
        assert language_id.pooled(net, [data])[0] == pytest.approx(np.mean(found, axis=0), abs=1e-4)
