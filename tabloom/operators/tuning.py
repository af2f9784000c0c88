"""Choosing model settings by cross-validation on hash folds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from tabloom.config import FIT_PARALLELISM, FOLDS
from tabloom.operators.models import fit
from tabloom.operators.sampling import with_fold
from tabloom.session import shared_folder


# Rows of the subsample that one partition holds: fits run side by side, so a small table needs no more tasks.
PARTITION_ROWS = 50_000


def param_grid(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of the named settings."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def settings_of(maps: Sequence[dict], setting: int) -> dict[str, str]:
    return {param.name: str(value) for param, value in maps[setting].items()}


@dataclass(frozen=True)
class Tuned:
    """Result of a search: the refitted best model and one average score per setting."""

    maps: list[dict]
    fold_metrics: list[list[float]]  # [setting][fold]
    best_index: int
    best_model: Model

    @property
    def avg_metrics(self) -> list[float]:
        return [sum(folds) / len(folds) for folds in self.fold_metrics]

    def metrics_table(self, spark) -> DataFrame:
        """(setting, <one column per setting>, avg_auc): one row per grid point."""
        names = [param.name for param in self.maps[0]]
        rows = [
            (i, *settings_of(self.maps, i).values(), avg) for i, avg in enumerate(self.avg_metrics)
        ]
        schema = ", ".join(["setting int", *(f"{n} string" for n in names), "avg_auc double"])
        return spark.createDataFrame(rows, schema)

    def best_params(self, spark) -> DataFrame:
        """One row: the winning settings as text, and their average score."""
        return self.metrics_table(spark).filter(F.col("setting") == self.best_index)


def exact_auc(label: str = "label") -> BinaryClassificationEvaluator:
    """AUC over every distinct score instead of 1000 bins."""
    return BinaryClassificationEvaluator(labelCol=label, numBins=0)


def shared_fits(estimator: Estimator, maps: Sequence[dict]) -> list[list[int]]:
    """Grid points grouped by the fit that serves them, the point to fit last in its group.

    A boosted model contains every shorter one: its first n trees are the trees
    of the same settings with n rounds. Points that differ in the rounds alone
    share the longest fit. Other points stand alone.
    """
    if not isinstance(estimator, GBTClassifier) or estimator.isDefined("validationIndicatorCol"):
        return [[i] for i in range(len(maps))]
    groups: dict[tuple, list[int]] = {}
    for i, point in enumerate(maps):
        other = tuple(sorted((p.name, v) for p, v in point.items() if p.name != "maxIter"))
        groups.setdefault(other, []).append(i)
    return [sorted(g, key=lambda i: _rounds(estimator, maps[i])) for g in groups.values()]


def _rounds(estimator: GBTClassifier, point: dict) -> int:
    return point.get(estimator.maxIter, estimator.getMaxIter())


def margin_after(model: GBTClassificationModel, rows: DataFrame, rounds: int, output: str) -> DataFrame:
    """Add the class-1 margin of the model's first `rounds` trees."""
    parts = []
    for i, (tree, weight) in enumerate(zip(model.trees[:rounds], model.treeWeights)):
        tree.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(f"_tree{i}")
        rows = tree.transform(rows)
        parts.append(F.col(f"_tree{i}") * weight)
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return rows.withColumn(output, total)


def cross_validate(
    estimator: Estimator,
    train: DataFrame,
    grid: Mapping[str, Sequence],
    *,
    key: str,
    folds: int = FOLDS,
    parallelism: int = FIT_PARALLELISM,
    evaluator: BinaryClassificationEvaluator | None = None,
    partitions: int | None = None,
) -> Tuned:
    """Score every grid point on every fold, refit the best on all rows.

    The folds are a filter on the row hash. All fits of a run read one persisted
    table, dealt by the hash of the row key into `partitions` sorted partitions, by default one for each
    PARTITION_ROWS rows. A forest's bootstrap follows the layout, so the same rows and
    `partitions` give the same search whatever the layout they came in. Fits run side by side, each
    with a copy of its two thirds of the rows in the library's own form,
    and boosted grid points that differ in the rounds alone share one.
    """
    shared_folder(train.sparkSession)
    evaluator = evaluator or exact_auc(estimator.getLabelCol())
    maps = param_grid(estimator, grid)
    if partitions is None:
        partitions = 1 + train.select(key).count() // PARTITION_ROWS
    packed = with_fold(train, key, folds).repartition(partitions, key).sortWithinPartitions(key)
    packed = packed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        packed.count()
        scores = [[0.0] * folds for _ in maps]

        def run(task: tuple[int, list[int]]) -> None:
            fold, points = task
            model = fit(estimator.copy(maps[points[-1]]), packed.filter(F.col("fold") != fold))
            held_out = packed.filter(F.col("fold") == fold)
            scores[points[-1]][fold] = evaluator.evaluate(model.transform(held_out))
            for point in points[:-1]:
                margin = margin_after(model, held_out, _rounds(estimator, maps[point]), "_margin")
                scores[point][fold] = evaluator.evaluate(margin, {evaluator.rawPredictionCol: "_margin"})

        tasks = [(f, points) for f in range(folds) for points in shared_fits(estimator, maps)]
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            pool.map(inheritable_thread_target(train.sparkSession)(run), tasks, chunksize=1)
        averages = [sum(s) / folds for s in scores]
        best = max(range(len(maps)), key=averages.__getitem__)
        model = fit(estimator.copy(maps[best]), packed)
        return Tuned(maps, scores, best, model)
    finally:
        packed.unpersist()
