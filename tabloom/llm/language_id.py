"""Language of texts by a bidirectional gated recurrent network over bytes.

Texts are read in windows of WINDOW bytes. In each window one network runs forward and one
backward; the two states at a position give the probabilities of the languages
there, so every byte is labelled from both sides. A document's probabilities are the mean over all its
positions. Training is plain numpy: backpropagation through time with Adam steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.llm.arrow import in_arrow, slices
from tabloom.llm.common import fold, written

WINDOW = 64
STATES = 8
UNKNOWN = "und"
# Bounds of the training sample: documents of each language, fewer of each if there are many languages, but one at least.
SAMPLE_PER_LANGUAGE = 600
MAX_SAMPLE = 20_000
# Excerpts of a document, spread evenly over its whole text, and characters of each.
EXCERPTS, EXCERPT = 8, 64
EPOCHS, BATCH, RATE = 4, 256, 0.02
PIECE_BYTES = 1 << 20
LANES = 1024  # windows that run side by side when scoring


@dataclass
class Network:
    """Weights of both directions, stacked; gates in the order update, reset, candidate.

    Everything has the windows in its last axis, so that each step works on long contiguous rows.
    """

    languages: list[str]
    inputs: np.ndarray  # (2, 3 * STATES, 256): what a byte adds to the gates
    recurrent: np.ndarray  # (2, 3 * STATES, STATES)
    output: np.ndarray  # (2, languages, STATES)
    bias: np.ndarray  # (languages, 1)

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.output, self.bias]


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (windows, WINDOW), which of them are text, and the text of each window."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    data = np.zeros((int(counts.sum()), WINDOW), np.uint8)
    held = np.zeros(data.shape, bool)
    flat, held_flat, at = data.reshape(-1), held.reshape(-1), 0
    for text, n in zip(texts, counts, strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        held_flat[at : at + len(text)] = True
        at += n * WINDOW
    return data, held, np.repeat(np.arange(len(texts)), counts)


def _soften(x: np.ndarray) -> None:
    """x / (1 + |x|) in place: the squashing function, several times cheaper than tanh in numpy."""
    scale = np.abs(x)
    scale += 1.0
    x /= scale


def _gate_slope(gate: np.ndarray) -> np.ndarray:
    return 0.5 * (1 - np.abs(2 * gate - 1)) ** 2


def _forward(net: Network, data: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (2, STATES, WINDOW, windows) at each position, both directions in text order."""
    n, h = len(data), STATES
    bytes_at = np.ascontiguousarray(data.T)
    states = np.empty((2, h, WINDOW, n), np.float32)
    gates, own = np.empty((3 * h, n), np.float32), np.empty((3 * h, n), np.float32)
    for d in (0, 1):
        state = np.zeros((h, n), np.float32)
        for t in range(WINDOW):
            place = t if d == 0 else WINDOW - 1 - t
            np.take(net.inputs[d], bytes_at[place], axis=1, out=gates, mode="clip")
            np.matmul(net.recurrent[d], state, out=own)
            both = gates[: 2 * h]
            both += own[: 2 * h]
            _soften(both)
            both *= 0.5
            both += 0.5
            candidate = both[h:] * own[2 * h :]
            candidate += gates[2 * h :]
            _soften(candidate)
            if trace is not None:
                trace.append((state.copy(), own[2 * h :].copy(), both[:h].copy(), both[h:].copy(), candidate.copy()))
            state -= candidate
            state *= both[:h]
            state += candidate
            states[d, :, place] = state
    return states


def _probabilities(net: Network, states: np.ndarray) -> np.ndarray:
    """(languages, WINDOW, windows) at each position."""
    flat = states.reshape(2, STATES, -1)
    scores = net.output[0] @ flat[0]
    scores += net.output[1] @ flat[1]
    scores += net.bias
    scores -= scores.max(axis=0)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=0)
    return scores.reshape(-1, *states.shape[2:])


def _gradients(net: Network, data: np.ndarray, held: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradient by backpropagation through time."""
    h, n, trace = STATES, len(data), []
    states = _forward(net, data, trace)
    error = _probabilities(net, states)
    weight = (held.T / max(held.sum(), 1)).astype(np.float32)
    lanes = np.arange(n)
    true = error[label, :, lanes]  # (windows, WINDOW)
    loss = float(-(np.log(true + 1e-9) * weight.T).sum())
    error[label, :, lanes] -= 1
    error *= weight
    flat = error.reshape(len(error), -1)
    grad_output = np.stack([flat @ s.reshape(h, -1).T for s in states])
    grad_bias = flat.sum(axis=1, keepdims=True)
    grad_inputs, grad_recurrent = np.zeros_like(net.inputs), np.zeros_like(net.recurrent)
    for d in (0, 1):
        from_above = (net.output[d].T @ flat).reshape(h, WINDOW, n)
        carried = np.zeros((h, n), np.float32)
        for t in range(WINDOW - 1, -1, -1):
            place = t if d == 0 else WINDOW - 1 - t
            before, own, update, reset, candidate = trace[d * WINDOW + t]
            here = carried + from_above[:, place]
            d_candidate = here * (1 - update) * (1 - np.abs(candidate)) ** 2
            d_update = here * (before - candidate) * _gate_slope(update)
            d_reset = d_candidate * own * _gate_slope(reset)
            d_own = np.concatenate([d_update, d_reset, d_candidate * reset])
            grad_recurrent[d] += d_own @ before.T
            carried = here * update + net.recurrent[d].T @ d_own
            seen = np.zeros((n, 256), np.float32)
            seen[lanes, data[:, place]] = 1
            grad_inputs[d] += np.concatenate([d_update, d_reset, d_candidate]) @ seen
    return loss, [grad_inputs, grad_recurrent, grad_output, grad_bias]


def train(texts: list[str], languages: list[str], *, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Network fitted to excerpts and their languages; repeats exactly for the same rows."""
    names = sorted(set(languages))
    draw = np.random.default_rng(seed)
    net = Network(
        names,
        draw.normal(0, 0.3, (2, 3 * STATES, 256)).astype(np.float32),
        draw.normal(0, 0.3, (2, 3 * STATES, STATES)).astype(np.float32),
        draw.normal(0, 0.3, (2, len(names), STATES)).astype(np.float32),
        np.zeros((len(names), 1), np.float32),
    )
    if len(names) < 2:
        return net
    data, held, owner = _windows([t.encode() for t in texts])
    label = np.searchsorted(names, languages)[owner]
    first, second = [np.zeros_like(w) for w in net.weights()], [np.zeros_like(w) for w in net.weights()]
    step, total = 0, max(epochs, -(-200 * BATCH // max(len(data), 1)))
    for epoch in range(total):
        order = draw.permutation(len(data))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            _, grads = _gradients(net, data[pick], held[pick], label[pick])
            step += 1
            rate = RATE * (1 - epoch / total) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for w, g, m, v in zip(net.weights(), grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def label_positions(net: Network, text: str) -> np.ndarray:
    """(bytes, languages): the probabilities at each byte of one text."""
    data, held, _ = _windows([text.encode()])
    return _probabilities(net, _forward(net, data)).transpose(2, 1, 0)[held]


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """(texts, languages): mean probabilities over all bytes; NaN for an empty text."""
    data, held, owner = _windows(texts)
    sums = np.zeros((len(texts), len(net.languages)))
    for at in range(0, len(data), LANES):
        part = slice(at, at + LANES)
        found = _probabilities(net, _forward(net, data[part]))
        found *= held[part].T
        np.add.at(sums, owner[part], found.sum(axis=1).T)
    with np.errstate(invalid="ignore"):
        return sums / np.array([len(t) for t in texts], float)[:, None]


def _scorer(net: Network):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, PIECE_BYTES):
                letters = pc.fill_null(pc.match_substring_regex(part.column(1), r"\p{L}"), False).to_pylist()
                texts = [t.as_py().encode() if ok else b"" for t, ok in zip(part.column(1), letters, strict=True)]
                found = pooled(net, texts) if net.languages else np.zeros((len(texts), 1))
                best = found.argmax(axis=1) if net.languages else np.zeros(len(texts), int)
                known = [ok and bool(net.languages) for ok in letters]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([net.languages[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)]),
                        pa.array([float(min(f[b], 1.0)) if ok else 0.0 for f, b, ok in zip(found, best, known, strict=True)]),
                    ],
                    ["doc_id", "lang_pred", "score"],
                )

    return score


def held_out(id_column: Column) -> Column:
    """True where the crc32 of the id as text is 1 modulo 3; rows without an id are held out too."""
    return F.coalesce(fold(id_column, 3) == 1, F.lit(True))


def training_sample(docs: DataFrame, *, id_col: str, text_col: str, lang_col: str) -> tuple[list[str], list[str]]:
    """Excerpts and languages of a bounded sample of learnable rows.

    Of each language the rows with the smallest hashes of the id are taken, SAMPLE_PER_LANGUAGE of them or, with many
    languages, an equal part of MAX_SAMPLE; no language is left out. EXCERPTS pieces of each text are used, one from each
    equal part of it, at a place that follows from the hash as well.
    """
    learnable = ~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
    usable = docs.where(learnable).select(
        F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    sizes = written(usable.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_n")), "languages")
    each = max(1, min(SAMPLE_PER_LANGUAGE, MAX_SAMPLE // max(sizes.count(), 1)))
    draw = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    # Far more rows than are taken pass the draw, so that the smallest hashes of a language are sorted out of few.
    drawn = usable.join(sizes, F.col("lang") == F.col("_lang")).where(draw * F.col("_n") < 4 * each + 64)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("key", F.lit("sample")), "key", F.xxhash64("text"))
    taken = drawn.withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= each)
    part = F.length("text") / EXCERPTS
    shift = F.pmod(F.xxhash64("key", F.lit("excerpt")), F.lit(1 << 20)) / float(1 << 20)

    def excerpt(i: Column) -> Column:
        begin = F.floor(part * i + shift * F.greatest(part - EXCERPT, F.lit(0)))
        return F.col("text").substr(begin.cast("int") + 1, F.lit(EXCERPT))

    pieces = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(EXCERPTS - 1)), excerpt))
    rows = taken.select(F.xxhash64("key").alias("order"), pieces.alias("pieces"), "lang").collect()
    found = [(p, r["lang"]) for r in sorted(rows) for p in r["pieces"] if p]
    return [p for p, _ in found], [lang for _, lang in found]


def identify(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of `docs`.

    Learns from rows with a language, a letter in the text, and a crc32 of the id modulo 3 other than 1;
    rows without an id are held out. `und` with score 0 for null, for texts without a letter, and for all
    rows where nothing can be learnt. `score` is the pooled probability of the predicted language.
    """
    texts, languages = training_sample(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    net = train(texts, languages)
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).transform(
        in_arrow,
        _scorer(net), "doc_id long, lang_pred string, score double"
    )
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
