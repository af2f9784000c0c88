"""Boosted trees for more rows than the library's trainer can hold as objects.

The method is that of the library: cuts from a sample of the rows, trees grown level by level on counts by (node, feature, bin),
a first tree of the labels -1 and 1 and further trees of the gradient of the log loss. The training rows are packed once into
blocks of one byte a cell, written once; with their margins they stay persisted. A level is one aggregate over them, of which only the
sums by (node, feature, bin) reach the driver. The result is the library's own model.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from tabloom.session import delete_path, fresh_path

# Up to this many rows the library's own trainer is faster: its jobs are shorter, and its objects fit.
LIBRARY_ROWS = 500_000
# Rows that the cuts of a feature are found on, as in the library.
CUT_ROWS = 10_000
# Cells are bytes, and a level's sums are held on the driver.
MAX_BINS, MAX_FEATURES, MAX_DEPTH = 256, 256, 10
# Tasks that add up the sums of a level.
SUM_PARTITIONS = 8
# Blocks are large values, so batches are bounded in bytes.
BATCH_BYTES = "16m"
# Two gains within this share of a node's impurity are a tie, which the first feature and cut wins, as is a gain of nothing.
TIE = 1e-9

Batches = Iterator[pa.RecordBatch]


def is_plain(estimator: GBTClassifier, train: DataFrame) -> bool:
    """Whether the estimator asks for nothing but trees over all rows and numeric features, narrow and shallow enough."""
    attributes = train.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {})
    return (
        not any(estimator.isDefined(name) for name in ("weightCol", "validationIndicatorCol"))
        and estimator.getSubsamplingRate() == 1.0
        and estimator.getFeatureSubsetStrategy() in ("all", "auto")
        and estimator.getMinWeightFractionPerNode() == 0.0
        and estimator.getMaxBins() <= MAX_BINS
        and 1 <= estimator.getMaxDepth() <= MAX_DEPTH
        and 1 <= attributes.get("num_attrs", 0) <= MAX_FEATURES
        and set(attributes.get("attrs", {})) <= {"numeric"}
    )


@dataclass
class Tree:
    """A regression tree as lists by node; the high child follows the low one, and a leaf is its own child."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    count: list[float] = field(default_factory=list)
    total: list[float] = field(default_factory=list)
    squares: list[float] = field(default_factory=list)

    def add(self, count: float, total: float, squares: float) -> int:
        node = len(self.low)
        # No bin is above the cut of a leaf.
        values = (0, MAX_BINS, node, -1.0, count, total, squares)
        for column, value in zip(vars(self).values(), values, strict=True):
            column.append(value)
        return node

    def impurity(self, node: int) -> float:
        mean = self.total[node] / self.count[node]
        return max(self.squares[node] / self.count[node] - mean * mean, 0.0)

    def values(self) -> np.ndarray:
        return np.array(self.total) / np.array(self.count)

    def depth(self) -> int:
        levels = [0] * len(self.low)
        for node, low in enumerate(self.low):
            if low != node:
                levels[low] = levels[low + 1] = levels[node] + 1
        return max(levels)

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of `bins`, an array by feature and row."""
        feature, cut, low = np.array(self.feature), np.array(self.cut), np.array(self.low)
        rows = bins.shape[1]
        cells, column = bins.ravel(), np.arange(rows)
        at = np.zeros(rows, np.intp)
        for _ in range(self.depth()):
            at = low[at] + (cells[feature[at] * rows + column] > cut[at])
        return at


def find_cuts(sample: np.ndarray, bins: int) -> list[np.ndarray]:
    """For each column the cuts between at most `bins` bins of about equal numbers of rows."""
    found = []
    for column in sample.T:
        values, counts = np.unique(column, return_counts=True)
        middles = (values[:-1] + values[1:]) / 2
        if len(middles) > bins - 1:
            stride, passed, chosen = len(column) / bins, counts.cumsum(), []
            target = stride
            for i in range(len(middles)):
                if abs(passed[i] - target) < abs(passed[i + 1] - target):
                    chosen.append(i)
                    target += stride
            middles = middles[chosen]
        found.append(middles)
    return found


def _matrix(batch: pa.RecordBatch, features: int) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    if batch.column("x").null_count or len(flat) != batch.num_rows * features:
        raise ValueError(f"a row has no vector of {features} features")
    return flat.reshape(-1, features)


def _block(bins: np.ndarray, label: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([a.tobytes()], pa.binary()) for a in (bins, label, margin)]
    return pa.RecordBatch.from_arrays(cells, ["bins", "label", "margin"])


def _blocks(batches: Batches, features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for bins, label, margin in zip(*(batch.column(c) for c in ("bins", "label", "margin")), strict=True):
            yield (
                np.frombuffer(bins.as_buffer(), np.uint8).reshape(features, -1),
                np.frombuffer(label.as_buffer(), np.int8), np.frombuffer(margin.as_buffer(), np.float64),
            )


BLOCK = "bins binary, label binary, margin binary"


def pack(rows: DataFrame, cuts: Sequence[np.ndarray]) -> DataFrame:
    """Rows (x, y) as blocks of bin numbers by feature, labels -1 and 1, and margins of 0."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch, len(cuts)), batch.column("y").to_numpy(zero_copy_only=False)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("a label is neither 0 nor 1")
            bins = np.empty(x.shape[::-1], np.uint8)
            for i, column in enumerate(cuts):
                bins[i] = np.searchsorted(column, x[:, i])
            yield _block(bins, (2 * y - 1).astype(np.int8), np.zeros(len(y)))

    return rows.mapInArrow(run, BLOCK)


def _gradient(label: np.ndarray, margin: np.ndarray, first: bool) -> np.ndarray:
    """What the next tree is fitted to."""
    if first:
        return label.astype(np.float64)
    with np.errstate(over="ignore"):
        return 4.0 * label / (1.0 + np.exp(2.0 * label * margin))


def _advance(blocks: DataFrame, tree: Tree, weight: float, features: int) -> DataFrame:
    """The blocks with the margins of one more tree."""

    def run(batches: Batches) -> Batches:
        values = weight * tree.values()
        for bins, label, margin in _blocks(batches, features):
            yield _block(bins, label, margin + values[tree.leaves(bins)])

    return blocks.mapInArrow(run, BLOCK)


def _level_sums(
    blocks: DataFrame, tree: Tree, nodes: Sequence[int], features: int, bins: int, first: bool, squares: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Number, sum and sum of squares of the target in each of `nodes`, and by (node, feature, bin).

    Each task adds up its blocks; the sums of tasks are added by a grouped aggregate. The squares by bin are counted on request.
    """
    cells = len(nodes) * features * bins

    def run(batches: Batches) -> Batches:
        place = np.full(len(tree.low), -1, np.intp)
        place[list(nodes)] = np.arange(len(nodes))
        width = len(nodes) * bins
        sums = np.zeros((3, features, width))
        whole = np.zeros((3, len(nodes)))
        for cell, label, margin in _blocks(batches, features):
            target, at = _gradient(label, margin, first), place[tree.leaves(cell)]
            here = at >= 0
            if not here.all():
                cell, target, at = cell[:, here], target[here], at[here]
            powers = (None, target, target * target)
            for power, weights in enumerate(powers):
                whole[power] += np.bincount(at, weights, len(nodes))
            base = at * bins
            for i in range(features):
                slots = base + cell[i]
                for power, weights in enumerate(powers if squares else powers[:2]):
                    sums[power, i] += np.bincount(slots, weights, width)
        by_cell = sums.reshape(3, features, len(nodes), bins).transpose(0, 2, 1, 3).reshape(3, -1)
        every = np.concatenate([by_cell, whole], axis=1)
        used = np.flatnonzero(every[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array(row[used]) for row in every)], ["slot", "n", "s", "q"]
        )

    partial = blocks.mapInArrow(run, "slot int, n double, s double, q double")
    # A task names each slot once, so nothing is gained by adding up before the shuffle.
    total = partial.repartition(SUM_PARTITIONS, "slot").groupBy("slot").agg(*(F.sum(c).alias(c) for c in "nsq")).toArrow()
    every = np.zeros((3, cells + len(nodes)))
    slot = total.column("slot").to_numpy()
    for row, name in zip(every, "nsq", strict=True):
        row[slot] = total.column(name).to_numpy()
    return every[:, cells:], every[:, :cells].reshape(3, len(nodes), features, bins)


def _grow(blocks: DataFrame, estimator: GBTClassifier, features: int, bins: int, first: bool) -> Tree:
    """One tree; each level is one job."""
    tree, level, smallest = Tree(), [], estimator.getMinInstancesPerNode()
    level.append(tree.add(1.0, 0.0, 0.0))
    for depth in range(estimator.getMaxDepth()):
        last = depth == estimator.getMaxDepth() - 1
        whole, cells = _level_sums(blocks, tree, level, features, bins, first, squares=last)
        below = cells.cumsum(axis=3)
        following = []
        for i, node in enumerate(level):
            n, s, q = (float(v) for v in whole[:, i])
            tree.count[node], tree.total[node], tree.squares[node] = n, s, q
            impurity = tree.impurity(node)
            ln, ls, lq = below[:, i, :, :-1]
            rn, rs = n - ln, s - ls
            fits = (ln >= smallest) & (rn >= smallest)
            if impurity < np.finfo(float).eps or not fits.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(fits, (ls**2 / ln + rs**2 / rn - s * s / n) / n, -np.inf)
            best = gain.max()
            if best <= TIE * impurity or best < estimator.getMinInfoGain():
                continue
            feature, cut = (int(v) for v in np.unravel_index(np.argmax(gain >= best - TIE * impurity), gain.shape))
            low = tree.add(float(ln[feature, cut]), float(ls[feature, cut]), float(lq[feature, cut]))
            high = tree.add(float(rn[feature, cut]), float(rs[feature, cut]), q - float(lq[feature, cut]))
            tree.feature[node], tree.cut[node], tree.low[node], tree.gain[node] = feature, cut, low, float(best)
            following += [low, high]
        level = following
        if not level:
            break
    return tree


def _as_model(estimator: GBTClassifier, train: DataFrame, trees: Sequence[Tree], cuts: Sequence[np.ndarray]) -> GBTClassificationModel:
    """The trees as a model of the library, read from a saved model of one tree in which only the trees are replaced."""
    spark = train.sparkSession
    label = train.schema[estimator.getLabelCol()].metadata
    sparse = Vectors.sparse(len(cuts), [])
    rows = spark.createDataFrame([(sparse, 0.0), (sparse, 1.0)], [estimator.getFeaturesCol(), estimator.getLabelCol()]).coalesce(1)
    rows = rows.withColumn(estimator.getLabelCol(), F.col(estimator.getLabelCol()).alias(estimator.getLabelCol(), metadata=label))
    saved, path = fresh_path(spark, "boosted-frame"), fresh_path(spark, "boosted-model")
    estimator.copy({estimator.maxIter: 1}).fit(rows).save(saved)
    about = json.loads(spark.read.text(f"{saved}/metadata").first()[0])
    about["numTrees"] = len(trees)
    if "maxIter" in about["paramMap"]:
        about["paramMap"]["maxIter"] = estimator.getMaxIter()
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    frame = spark.read.parquet(f"{saved}/treesMetadata")
    number, text, weight = frame.columns
    one = frame.first()
    weights = [1.0, *[estimator.getStepSize()] * (len(trees) - 1)]
    frame = spark.createDataFrame([(i, one[text], w) for i, w in enumerate(weights)], frame.schema)
    frame.coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = []
    for t, tree in enumerate(trees):
        for node, low in enumerate(tree.low):
            leaf = low == node
            cut = (-1, [], -1) if leaf else (tree.feature[node], [float(cuts[tree.feature[node]][tree.cut[node]])], -1)
            stats = [tree.count[node], tree.total[node], tree.squares[node]]
            children = (-1, -1) if leaf else (low, low + 1)
            nodes.append((t, (
                node, tree.total[node] / tree.count[node], tree.impurity(node), stats, int(tree.count[node]),
                tree.gain[node], *children, cut,
            )))
    schema = (
        "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint,"
        " gain double, leftChild int, rightChild int,"
        " split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
    )
    spark.createDataFrame(nodes, schema).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def fit_boosted(estimator: GBTClassifier, train: DataFrame, count: int) -> GBTClassificationModel:
    """Fit to the `count` rows of `train`; the settings must be plain."""
    spark = train.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    rows = train.select(
        vector_to_array(estimator.getFeaturesCol()).alias("x"), F.col(estimator.getLabelCol()).cast("double").alias("y")
    )
    features = train.schema[estimator.getFeaturesCol()].metadata["ml_attr"]["num_attrs"]
    wanted = max(estimator.getMaxBins() ** 2, CUT_ROWS)
    drawn = rows if count <= wanted else rows.sample(False, wanted / count, estimator.getSeed())
    sample = np.concatenate([_matrix(b, features) for b in drawn.select("x").toArrow().to_batches()])
    cuts = find_cuts(sample, min(estimator.getMaxBins(), count))
    bins = 1 + max(len(c) for c in cuts)
    path = fresh_path(spark, "boosted-blocks")
    blocks, before, trees = None, None, []
    try:
        # Read from a table, the rounds have a plan of their own. A persisted plan over an adaptive one is adaptive too and states what
        # is below it twice, as it was and as it is, so over rows that were shuffled the text of the plan doubled with each round.
        pack(rows, cuts).write.parquet(path)
        blocks = spark.read.schema(BLOCK).parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
        for turn in range(estimator.getMaxIter()):
            if turn:
                before, blocks = blocks, _advance(blocks, trees[-1], estimator.getStepSize() if turn > 1 else 1.0, features)
                blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
                blocks.count()
                before.unpersist()
            trees.append(_grow(blocks, estimator, features, bins, first=not turn))
    finally:
        for held in (blocks, before):
            if held is not None:
                held.unpersist()
        delete_path(spark, path)
    return _as_model(estimator, train, trees, cuts)
