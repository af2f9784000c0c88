"""Quality of texts by supervised subword embeddings.

Every word and every character n-gram of a word (its edges included) is hashed to a vector. A document is the average of the
vectors of all its words and n-grams; a softmax layer turns the average into class probabilities. Vectors and
layer are learnt together by stochastic gradient descent in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.arrow import in_arrow, slices
from tabloom.llm.labels import held_out, labelled_sample

BUCKET_BITS = 17
VECTOR = 10
NGRAMS = (3, 4, 5)
# Bound of the training sample in rows; of each, its whole text is learnt from.
MAX_LABELLED = 4000
EPOCHS, BATCH, RATE = 8, 32, 0.3
# A document changes the average of its own vectors by about RATE * GAIN / (its number of
# buckets); without the gain texts of thousands of n-grams would learn nothing.
GAIN = 100.0
THRESHOLD = 0.3
PIECE_BYTES = 1 << 20
PIECE_CHARS = 1 << 19  # a longer text is cut at blanks, and its pieces are added up

SAME_WORD = 0
_BLANK = 32
_draw = np.random.default_rng(11)
_PLACES = _draw.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIZES = {n: _draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for n in NGRAMS}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(29))) * _MIX
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and n-grams of all texts, and the text each belongs to, in the order of the texts.

    The word pair of a word and itself has the one bucket SAME_WORD, whatever the word.
    Blanks and control characters end words. An n-gram may begin or end with the blank
    at the edge of its word, and never spans two words.
    """
    # a blank before and behind each text
    parts = [np.frombuffer(f" {t} ".encode("utf-32-le", "replace"), np.uint32) for t in texts]
    codes = np.concatenate(parts).astype(np.uint64) if parts else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(p) for p in parts])
    blank = codes <= _BLANK
    codes[blank] = _BLANK
    codes += np.uint64(1)
    found, owners = [], []
    with np.errstate(over="ignore"):
        starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
        if len(starts):
            at = np.arange(len(codes))
            begin = np.zeros(len(codes), np.int64)
            begin[starts] = starts
            begin = np.maximum.accumulate(begin)
            weighted = codes * _PLACES[(at - begin) & 63]
            weighted[blank] = 0
            words = np.add.reduceat(weighted, starts)
            found.append(_bucket(words))
            owners.append(owner[starts])
            again = (words[1:] == words[:-1]) & (owner[starts[1:]] == owner[starts[:-1]])
            found.append(np.full(int(again.sum()), SAME_WORD, np.int32))
            owners.append(owner[starts[1:]][again])
        blanks = np.concatenate([[0], np.cumsum(blank)])
        for n, factors in _SIZES.items():
            size = len(codes) - n + 1
            if size <= 0:
                continue
            inner = blanks[n - 1 : n - 1 + size] - blanks[1 : 1 + size]  # blanks inside the n-gram
            # one blank at an edge is an edge of the word; two are a short word between them
            valid = inner == 0
            rolled = codes[:size] * factors[0]
            for i, factor in enumerate(factors[1:], 1):
                rolled += codes[i : i + size] * factor
            found.append(_bucket(rolled[valid]))
            owners.append(owner[:size][valid])
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    return np.concatenate(found), np.concatenate(owners)


def pieces(text: str) -> Iterator[str]:
    """Parts of a text of about PIECE_CHARS, cut at blanks: no word and no n-gram is cut."""
    low = 0
    while low < len(text):
        high = low + PIECE_CHARS
        while high < len(text) and ord(text[high]) > _BLANK:
            high += 1
        yield text[low:high]
        low = high


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of one text, and how often each occurs."""
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    last = None
    for piece in pieces(text):
        total += np.bincount(subwords([piece])[0], minlength=len(total))
        words = _edge_words(piece)
        if words:
            total[SAME_WORD] += last == words[0]
            last = words[1]
    held = np.flatnonzero(total)
    return held.astype(np.int32), total[held]


def _edge_words(piece: str) -> tuple[str, str] | None:
    """The first and the last word of a piece."""
    low, high = 0, len(piece)
    while low < high and ord(piece[low]) <= _BLANK:
        low += 1
    while high > low and ord(piece[high - 1]) <= _BLANK:
        high -= 1
    if low == high:
        return None
    end, begin = low, high
    while end < high and ord(piece[end]) > _BLANK:
        end += 1
    while begin > low and ord(piece[begin - 1]) > _BLANK:
        begin -= 1
    return piece[low:end], piece[begin:high]


@dataclass
class Model:
    vectors: np.ndarray  # (buckets, VECTOR)
    layer: np.ndarray  # (VECTOR, 2)
    bias: np.ndarray  # (2,)

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 of each text: softmax of the layer over the average vector.

        The layer is linear, so it is applied to each bucket once and the results are averaged.
        """
        margin = (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float64)
        buckets, owner = subwords([t if len(t) <= PIECE_CHARS else "" for t in texts])
        count = np.bincount(owner, minlength=len(texts))
        total = np.bincount(owner, margin[buckets], len(texts)) if len(buckets) else np.zeros(len(texts))
        for i, text in enumerate(texts):
            if len(text) > PIECE_CHARS:
                held, times = counts(text)
                count[i], total[i] = times.sum(), margin[held] @ times
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias[1] - self.bias[0])))


def train(
    documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, epochs: int = EPOCHS, seed: int = 3
) -> Model:
    """Fit vectors and layer to documents given as their buckets and counts; repeats exactly for the same rows."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / VECTOR, 1 / VECTOR, (1 << BUCKET_BITS, VECTOR)).astype(np.float32)
    model = Model(vectors, np.zeros((VECTOR, 2), np.float32), np.zeros(2, np.float32))
    usable = [i for i, (b, _) in enumerate(documents) if len(b)]
    if not usable:
        return model
    total = epochs * -(-len(usable) // BATCH)
    step = 0
    for _ in range(epochs):
        order = draw.permutation(usable)
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            flat, times = (np.concatenate([documents[i][k] for i in pick]) for k in (0, 1))
            held = np.array([len(documents[i][0]) for i in pick])
            starts = np.cumsum(held) - held
            sizes = np.add.reduceat(times, starts)
            means = np.add.reduceat(model.vectors[flat] * times[:, None].astype(np.float32), starts, axis=0) / sizes[:, None]
            scores = means @ model.layer + model.bias
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            error = scores / scores.sum(axis=1, keepdims=True)
            error[np.arange(len(pick)), labels[pick]] -= 1
            rate = RATE * (1 - step / total)
            to_means = error @ model.layer.T
            model.layer -= (rate * means.T @ error / len(pick)).astype(np.float32)
            model.bias -= (rate * error.sum(axis=0) / len(pick)).astype(np.float32)
            # each document's step is shared by its buckets
            change = (rate * GAIN * to_means / sizes[:, None]).astype(np.float32)
            where, place = np.unique(flat, return_inverse=True)
            rows = np.repeat(np.arange(len(pick)), held)
            for k in range(VECTOR):
                model.vectors[where, k] -= np.bincount(place, change[rows, k] * times, len(where)).astype(np.float32)
            step += 1
    return model


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1, PIECE_BYTES):
            held = [counts(t) for t in part.column(1).to_pylist()]
            columns = [pa.array([x[k].astype(np.int32).tobytes() for x in held], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns, part.column(2)], ["id", "x", "n", "label"])


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, PIECE_BYTES):
                found = model.probabilities([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return score


def score_quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of `docs`.

    Learns from the whole texts of at most MAX_LABELLED labelled rows whose crc32 of the id is not 0 modulo 5, which reach
    the driver as counts of at most 2 ** BUCKET_BITS buckets each; scores whole texts. Null and empty texts get the score of the bias alone, one half without any
    usable label. Rows without an id are scored and held out; repeated rows are scored each.
    """
    sample = labelled_sample(docs, labels, label_col, MAX_LABELLED, id_col=id_col, text_col=text_col)
    rows = sample.select(F.col("id").cast("string").alias("id"), "text", "label")
    rows = sorted(rows.transform(in_arrow, _bucket_rows, "id string, x binary, n binary, label int").collect())
    documents = [tuple(np.frombuffer(r[c], np.int32) for c in ("x", "n")) for r in rows]
    model = train(documents, np.array([int(r["label"] > 0) for r in rows], int))
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).transform(
        in_arrow,
        _scorer(model), "doc_id long, score double"
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
