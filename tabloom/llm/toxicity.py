"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A bounded sample of labelled rows is split by hash: from one part a lexicon is learnt (words and beginnings of words
whose documents are labelled toxic far more often than others), on the second the trees are grown, the third fits the
isotonic map from tree scores to probabilities. So neither trees nor calibration see
the rows that made the lexicon.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.arrow import in_arrow, slices
from tabloom.llm.common import written
from tabloom.llm.labels import held_out, labelled_sample

MAX_LABELLED = 20_000
LEXICON_PART, TREES_PART = 50, 80  # percent of the sample: lexicon below 50, trees below 80
STEMS = (4, 5, 6, 7, 8)
MIN_DOCS, MIN_ODDS, MAX_ENTRIES = 4, 6.0, 3000
TREES, DEPTH, BINS, RATE, RIDGE = 80, 4, 32, 0.15, 2.0
NEAR = 5  # words between a lexicon word and a second person
PIECE_BYTES = 1 << 21
MAX_KNOWN_WORDS = 200_000

SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "sie ihnen tú ti tus usted ustedes vosotros vuestro".split()
)
_EDGES = ".,;:!?\"'()[]{}*#$%&|<>-_"
_OBFUSCATED = re.compile(r"[^\W\d_][\d@$*#%&!|]+[^\W\d_]")
_REPEATED = re.compile(r"([^\W\d_])\1{2,}")


def units(word: str) -> list[str]:
    """What of a word can be in the lexicon: the word, and its beginnings marked by a dash."""
    return [word, *(word[:n] + "-" for n in STEMS if len(word) > n)]


def _words(text: str) -> list[str]:
    return [w.strip(_EDGES) for w in text.lower().split()]


@dataclass
class Lexicon:
    weights: dict[str, float]

    def __post_init__(self) -> None:
        self.known: dict[str, float] = {}

    def weight(self, raw: str) -> float:
        """Weight of a lower-case word with its punctuation; 0 if it is not in the lexicon, -1 for a second person."""
        found = self.known.get(raw)
        if found is None:
            if len(self.known) > MAX_KNOWN_WORDS:
                self.known = {}
            word = raw.strip(_EDGES)
            if word in SECOND_PERSON:
                found = -1.0
            else:
                found = max((self.weights.get(u, 0.0) for u in units(word)), default=0.0)
            self.known[raw] = found
        return found


FEATURES = (
    "log_words", "log_hits", "hit_density", "weight_density", "top_weight", "second_density",
    "hits_near_second", "nearest_second", "capital_share", "shouted_share", "exclamations", "questions",
    "punctuation", "digits", "obfuscated", "repeated", "mean_word", "beyond_ascii",
)


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one whole text, in the order of FEATURES; all zero without words."""
    raw = text.lower().split()
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    weights = list(map(lexicon.weight, raw))
    hits = [i for i, w in enumerate(weights) if w > 0]
    second = [i for i, w in enumerate(weights) if w < 0]
    near, nearest = 0, 1000
    if hits and second:
        places = np.array(second)
        after = np.searchsorted(places, hits)
        left = np.array(hits) - places[np.maximum(after - 1, 0)]
        right = places[np.minimum(after, len(places) - 1)] - np.array(hits)
        distance = np.minimum(np.abs(left), np.abs(right))
        near, nearest = int((distance <= NEAR).sum()), int(min(distance.min(), 1000))
    capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    letters = max(sum(map(len, raw)), 1)
    marks = {c: text.count(c) for c in "!?.,;:*#$%&@|'\"()-_"}
    return [
        math.log1p(n),
        math.log1p(len(hits)),
        len(hits) / n,
        sum(weights[i] for i in hits) / n,
        max((weights[i] for i in hits), default=0.0),
        len(second) / n,
        float(near),
        float(nearest),
        capitals / letters,
        sum(1 for w in text.split() if len(w) > 2 and w.isupper()) / n,
        marks["!"] / n,
        marks["?"] / n,
        sum(marks.values()) / n,
        sum(map(text.count, "0123456789")) / n,
        len(_OBFUSCATED.findall(text)) / n,
        len(_REPEATED.findall(text)) / n,
        letters / n,
        0.0 if text.isascii() else 1.0,
    ]


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Units of the lexicon part with MIN_DOCS toxic documents and a ratio of frequencies of MIN_ODDS or more.

    Each task counts its documents' units before they are shuffled; the MAX_ENTRIES best reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            names = list(toxic.keys() | clean.keys())
            out = pa.RecordBatch.from_pydict(
                {"unit": pa.array(names, pa.string()), "toxic": pa.array([toxic[u] for u in names], pa.int64()),
                 "clean": pa.array([clean[u] for u in names], pa.int64())}
            )
            toxic.clear()
            clean.clear()
            return out

        for batch in batches:
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (toxic if label else clean).update({u for w in set(_words(text)) for u in units(w)})
                if len(toxic) + len(clean) > MAX_KNOWN_WORDS:
                    yield flush()
        yield flush()

    part = sample.where(F.col("part") < LEXICON_PART)
    totals = part.agg(F.count(F.when(F.col("label") == 1, 1)), F.count(F.when(F.col("label") == 0, 1))).first()
    toxic, clean = (n + 2 for n in totals)
    counts = (
        part.select("text", "label").transform(in_arrow, count, "unit string, toxic long, clean long")
        .groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    odds = ((F.col("toxic") + 0.5) / toxic) / ((F.col("clean") + 0.5) / clean)
    best = (
        counts.where(F.col("toxic") >= MIN_DOCS).withColumn("odds", odds).where(F.col("odds") >= MIN_ODDS)
        .orderBy(F.desc("odds"), "unit").limit(MAX_ENTRIES).collect()
    )
    return Lexicon({r["unit"]: math.log(r["odds"]) for r in best if r["unit"] and r["unit"] not in SECOND_PERSON})


@dataclass
class Forest:
    """Boosted trees of equal depth: feature and threshold of each inner node, value of each leaf."""

    start: float
    feature: np.ndarray  # (trees, 2 ** DEPTH - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2 ** DEPTH)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosting on the logistic loss: Newton leaves, splits over quantile bins, RIDGE on leaf values."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    if not len(y) or y.min() == y.max():
        none = np.zeros((0, inner))
        return Forest(math.log(share / (1 - share)), none.astype(int), none, np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
    # Zero against more is the first question for a sparse feature, whatever the quantiles are.
    edges = [np.union1d(e, [0.0]) for e in edges]
    bins = np.stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T, strict=True)], axis=1)
    width = max(len(e) for e in edges) + 1
    start = math.log(share / (1 - share))
    raw = np.full(len(y), start)
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), int)
        feature, threshold, leaf = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(leaves)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-9)
            at = node - first
            for f in range(x.shape[1]):
                key = at * width + bins[:, f]
                g = np.bincount(key, gradient, count * width).reshape(count, width)
                h = np.bincount(key, hessian, count * width).reshape(count, width)
                gl, hl = g.cumsum(axis=1), h.cumsum(axis=1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hl < 1) | (ht - hl < 1)] = 0
                gain = gain[:, : len(edges[f])]
                cut = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(count), cut] > best):
                    best[k] = gain[k, cut[k]]
                    feature[first + k], threshold[first + k] = f, edges[f][cut[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - inner
        leaf = RATE * np.bincount(at, gradient, leaves) / (np.bincount(at, hessian, leaves) + RIDGE)
        raw += leaf[at]
        trees.append((feature, threshold, leaf))
    return Forest(start, *(np.stack(part) for part in zip(*trees, strict=True)))


@dataclass
class Calibration:
    """A non-decreasing map by its knots, linear in between."""

    knots: np.ndarray
    values: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.knots, self.values) if len(self.knots) else 1 / (1 + np.exp(-raw))


def isotonic(raw: np.ndarray, y: np.ndarray) -> Calibration:
    """Pool adjacent violators; equal scores are pooled first. Without both labels the logistic map stays."""
    if not len(y) or y.min() == y.max():
        return Calibration(np.empty(0), np.empty(0))
    scores, place = np.unique(raw, return_inverse=True)
    pools: list[list[float]] = []  # sum, count, first, last
    for s, total, count in zip(scores, np.bincount(place, y), np.bincount(place), strict=True):
        pools.append([total, count, s, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            total, count, _, last = pools.pop()
            pools[-1][0] += total
            pools[-1][1] += count
            pools[-1][3] = last
    knots = np.array([s for p in pools for s in ((p[2], p[3]) if p[3] > p[2] else (p[2],))])
    values = np.array([p[0] / p[1] for p in pools for _ in range(2 if p[3] > p[2] else 1)])
    return Calibration(knots, values)


def _feature_rows(lexicon: Lexicon):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(lexicon.weights)
        for batch in batches:
            found = [features(t, own) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["x", "label", "part"]
            )

    return rows


@dataclass
class Model:
    lexicon: Lexicon
    forest: Forest
    calibration: Calibration

    def worker(self) -> Model:
        """A copy for one task, with a memory of words of its own."""
        return Model(Lexicon(self.lexicon.weights), self.forest, self.calibration)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([features(t or "", self.lexicon) for t in texts]).reshape(-1, len(FEATURES))
        return np.clip(self.calibration(self.forest.raw(x)), 0.0, 1.0)


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.worker()
        for batch in batches:
            for part in slices(batch, 1, PIECE_BYTES):
                found = own.scores(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return score


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str) -> Model:
    """The model of the labelled rows of `docs`, without those held out."""
    sample = written(
        labelled_sample(docs, labels, label_col, MAX_LABELLED, id_col=id_col, text_col=text_col), "toxicity-sample"
    )
    lexicon = learn_lexicon(sample)
    rows = (
        sample.where(F.col("part") >= LEXICON_PART).select("text", "label", "part")
        .transform(in_arrow, _feature_rows(lexicon), "x array<double>, label int, part int").collect()
    )
    x = np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES))
    y, part = np.array([r["label"] for r in rows], float), np.array([r["part"] for r in rows], int)
    order = np.lexsort([*x.T, y])  # the same model whatever the order of the rows
    x, y, part = x[order], y[order], part[order]
    forest = grow(x[part < TREES_PART], y[part < TREES_PART])
    last = part >= TREES_PART
    return Model(lexicon, forest, isotonic(forest.raw(x[last]), y[last]))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of `docs`.

    Learns from at most MAX_LABELLED labelled rows whose crc32 of the id is not 0 modulo 5. Null and empty texts have the
    features of no words and get a score like any text; without usable labels all scores are one half, or the share of
    the one label there is. Rows without an id are scored and held out; repeated rows are scored each.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).transform(
        in_arrow,
        _scorer(model), "doc_id long, score double"
    )
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows whose score is one half or more, judged where they stand: no shuffle.

    Rows without an id are judged like all others. Without labels of both kinds nothing tells texts apart, and all rows stay.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, label_col="toxic")
    if not len(model.forest.feature):
        return docs
    columns = docs.columns
    place = columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.worker()
        for batch in batches:
            for part in slices(batch, place, PIECE_BYTES):
                yield part.filter(pa.array(own.scores(part.column(place).to_pylist()) < 0.5, pa.bool_()))

    return docs.transform(in_arrow, keep, docs.schema)
