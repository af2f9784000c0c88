"""Fitted trees as tables: rows routed through them by joins, leaves and splits checked by aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tabloom.operators.features import vector_element
from tabloom.session import fresh_path

# Two gains within this share of a node's sum of squares are a tie.
TIE = 1e-9


def node_table(spark: SparkSession, model: Model) -> DataFrame:
    """(tree, node, rows, stats, gain, low, high, feature, threshold, left): one row per node of a saved tree model.

    `stats` are what the node was learned from: rows by class, or count, sum and sum of squares of the
    target. Leaves have null children. `threshold` is null and `left` lists the values that go to the low side where a
    feature is nominal. The model is on the driver already, so its table is small enough to broadcast.
    """
    path = fresh_path(spark, "tree-model")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData") if "nodeData" in saved.columns else F.struct(*(F.col(f"`{c}`") for c in saved.columns))
    tree = F.col("treeID") if "treeID" in saved.columns else F.lit(0)
    inner = node["leftChild"] >= 0
    numeric = node["split"]["numCategories"] < 0
    cut = node["split"]["leftCategoriesOrThreshold"]
    return saved.select(
        tree.alias("tree"), node["id"].alias("node"), node["rawCount"].alias("rows"), node["impurityStats"].alias("stats"),
        F.when(inner, node["gain"]).alias("gain"),
        F.when(inner, node["leftChild"]).alias("low"), F.when(inner, node["rightChild"]).alias("high"),
        F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner & numeric, F.get(cut, 0)).alias("threshold"), F.when(inner & ~numeric, cut).alias("left"),
    )


def goes_low(features: str) -> Column:
    """Whether a row with the columns of an inner node takes its low side."""
    value = vector_element(features, F.col("feature"))
    return F.when(F.col("left").isNull(), value <= F.col("threshold")).otherwise(F.array_contains("left", value))


def route(rows: DataFrame, features: str, nodes: DataFrame, depth: int) -> DataFrame:
    """`rows` once for each tree, with `tree` and the `node` each ends in.

    Each level is a lookup of the node a row has reached, by broadcast; no row is shuffled.
    """
    names = [c for c in rows.columns if c not in ("tree", "node")]
    trees = nodes.select("tree").distinct().orderBy("tree")
    numbers = [r["tree"] for r in trees.collect()]  # one row per tree
    inner = F.broadcast(nodes.where("low IS NOT NULL").select("tree", "node", "low", "high", "feature", "threshold", "left"))
    kept = [F.col(f"`{c}`") for c in names]
    at = rows.select(*kept, F.explode(F.array(*(F.lit(n) for n in numbers))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        step = F.when(F.col("low").isNull(), F.col("node")).when(goes_low(features), F.col("low")).otherwise(F.col("high"))
        at = at.join(inner, ["tree", "node"], "left").select(*kept, "tree", step.alias("node"))
    return at


def leaf_counts(routed: DataFrame, value: Column) -> DataFrame:
    """(tree, node, n, total): rows in each leaf, and the sum of `value` over them."""
    return routed.groupBy("tree", "node").agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def check_leaves(rows: DataFrame, features: str, label: str, nodes: DataFrame, depth: int) -> DataFrame:
    """(rows, positives, excess, differing) over all trees of a classifier fitted to all of `rows` without a bootstrap.

    `excess` is the number of leaves beyond that of splits (one for each tree), `differing` the number of leaves
    whose rows by class are not those that the model learned.
    """
    leaves = nodes.where("low IS NULL").select("tree", "node", "stats")
    found = leaf_counts(route(rows.select(features, label), features, nodes, depth), F.col(label))
    both = leaves.join(found, ["tree", "node"], "full")
    zeros, ones = F.get("stats", F.lit(0)), F.get("stats", F.lit(1))
    same = F.coalesce((zeros == F.col("n") - F.col("total")) & (ones == F.col("total")), F.lit(False))
    checked = both.agg(
        F.sum("n").alias("rows"), F.sum("total").alias("positives"), F.count("*").alias("leaves"), F.count_if(~same).alias("differing")
    )
    splits = nodes.where("low IS NOT NULL").agg(F.count("*").alias("splits")).scalar()
    return checked.select("rows", "positives", (F.col("leaves") - splits).alias("excess"), "differing")


def _ancestors(nodes: DataFrame, depth: int) -> DataFrame:
    """(tree, node, above): each node with itself and all nodes above it."""
    parents = nodes.where("low IS NOT NULL").select(
        "tree", F.col("node").alias("parent"), F.explode(F.array("low", "high")).alias("child")
    )
    level = nodes.where("low IS NULL").select("tree", "node", F.col("node").alias("above"))
    found = level
    for _ in range(depth):
        level = (
            level.alias("l").join(F.broadcast(parents).alias("p"), (F.col("l.tree") == F.col("p.tree")) & (F.col("l.above") == F.col("p.child")))
            .select("l.tree", "l.node", F.col("p.parent").alias("above"))
        )
        found = found.unionByName(level)
    return found


def _leaf_bins(rows: DataFrame, features: str, value: Column, nodes: DataFrame) -> DataFrame:
    """(tree, node, feature, bin, n, total): the rows of each leaf by bin, one row for each task that met them.

    As `route` for each tree, but for all rows of a batch at once, and no row is repeated for each feature. The nodes of a model
    that is on the driver already are sent to the tasks.
    """
    table = [r.asDict() for r in nodes.select("tree", "node", "low", "high", "feature", "threshold", "left").collect()]
    by_tree = {t: {r["node"]: r for r in table if r["tree"] == t} for t in sorted({r["tree"] for r in table})}

    def descend(tree: dict, node: int, x: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        split = tree[node]
        if split["low"] is None:
            yield node, at
            return
        cell = x[at, split["feature"]]
        low = cell <= split["threshold"] if split["left"] is None else np.isin(cell, split["left"])
        yield from descend(tree, split["low"], x, at[low])
        yield from descend(tree, split["high"], x, at[~low])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # (tree, leaf) -> count and total by (feature, bin)
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            bins = x.astype(np.int64)
            if (bins != x).any() or bins.min() < 0:
                raise ValueError(f"{features} holds a value that is no number of a bin")
            width, every = int(bins.max()) + 1, np.arange(len(y))
            for t, tree in by_tree.items():
                for leaf, at in descend(tree, 0, x, every):
                    if not len(at):
                        continue
                    slots = (bins[at] + np.arange(x.shape[1]) * width).ravel()
                    weights = np.repeat(y[at], x.shape[1])
                    found = np.stack([np.bincount(slots, w, x.shape[1] * width) for w in (None, weights)])
                    found = found.reshape(2, x.shape[1], width)
                    held = sums.get((t, leaf))
                    if held is not None:
                        wide = max(held.shape[2], width)
                        found, held = (np.pad(a, ((0, 0), (0, 0), (0, wide - a.shape[2]))) for a in (found, held))
                        found = found + held
                    sums[t, leaf] = found
        for (t, leaf), (n, total) in sums.items():
            feature, bin_ = np.nonzero(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(feature), t), pa.int32()), pa.array(np.full(len(feature), leaf), pa.int32()),
                    pa.array(feature, pa.int32()), pa.array(bin_.astype(np.float64)),
                    pa.array(n[feature, bin_].astype(np.int64)), pa.array(total[feature, bin_]),
                ],
                ["tree", "node", "feature", "bin", "n", "total"],
            )

    vectors = rows.select(vector_to_array(features).alias("x"), value.cast("double").alias("y"))
    return vectors.mapInArrow(run, "tree int, node int, feature int, bin double, n bigint, total double")


def split_gains(rows: DataFrame, features: str, value: Column, nodes: DataFrame, depth: int) -> DataFrame:
    """(tree, node, n, total, chosen, best): the gain of each split of a fitted tree, and the largest there is.

    `features` is a vector of bin numbers. Counts by (leaf, feature, bin) are added up in each task; the counts of a node are those of
    the leaves below it, and running sums over the bins of a feature give the gain of every cut. Gains are reductions of the sum of
    squares of `value`, in which order those of the Gini impurity are too.
    """
    leaves = _leaf_bins(rows, features, value, nodes).groupBy("tree", "node", "feature", "bin").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    )
    above = F.broadcast(_ancestors(nodes, depth))
    counts = (
        leaves.join(above, ["tree", "node"]).groupBy("tree", "above", "feature", "bin")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    whole = Window.partitionBy("tree", "above", "feature")
    running = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = counts.select(
        "tree", F.col("above").alias("node"), "feature", "bin",
        F.sum("n").over(running).alias("ln"), F.sum("total").over(running).alias("ls"),
        F.sum("n").over(whole).alias("n"), F.sum("total").over(whole).alias("s"),
    )
    rest = F.col("s") - F.col("ls")
    gain = F.when(
        F.col("ln") < F.col("n"),
        F.col("ls") ** 2 / F.col("ln") + rest**2 / (F.col("n") - F.col("ln")) - F.col("s") ** 2 / F.col("n"),
    )
    inner = nodes.where("low IS NOT NULL").select("tree", "node", F.col("feature").alias("own"), "threshold")
    here = (F.col("feature") == F.col("own")) & (F.col("bin") <= F.col("threshold"))
    return (
        cuts.withColumn("gain", gain).join(F.broadcast(inner), ["tree", "node"]).groupBy("tree", "node")
        .agg(
            F.max("n").alias("n"), F.max("s").alias("total"), F.max("gain").alias("best"),
            F.max_by("gain", F.when(here, F.col("bin"))).alias("chosen"),
        )
    )


def check_splits(rows: DataFrame, features: str, value: Column, nodes: DataFrame, depth: int) -> DataFrame:
    """(excess, violations, miscounted): the split certificate of a tree model fitted to all of `rows`.

    `excess` is the number of leaves beyond that of splits, `violations` the number of nodes with a cut that gains more than the one the
    model chose, `miscounted` the number of nodes that were learned from other rows than those that reach them.
    """
    gains = split_gains(rows, features, value, nodes, depth)
    both = nodes.join(gains, ["tree", "node"], "left")
    inner = F.col("low").isNotNull()
    # two classes, or count, sum and sum of squares
    classes = F.size("stats") == 2
    learned = F.when(classes, F.get("stats", F.lit(0)) + F.get("stats", F.lit(1))).otherwise(F.get("stats", F.lit(0)))
    learned_total = F.get("stats", F.lit(1))
    fair = F.coalesce(F.col("chosen") >= F.col("best") - TIE * F.col("n"), F.lit(False))
    counted = F.coalesce((learned == F.col("n")) & (F.abs(learned_total - F.col("total")) < 1e-6 * F.col("n")), F.lit(False))
    return both.agg(
        (F.count_if(~inner) - F.count_if(inner)).alias("excess"),
        F.count_if(inner & ~fair).alias("violations"), F.count_if(inner & ~counted).alias("miscounted"),
    )
