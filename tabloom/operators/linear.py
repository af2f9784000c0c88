"""Linear models of sparse vectors of any width: a certificate of the optimum, and ridge regression by conjugate gradients or elimination."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.linalg import DenseVector, SparseVector, Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.session import fresh_path

MAX_STEPS = 2000
# Rows that one task of a step reads, at least: a step is short, and a task has a cost of its own.
STEP_ROWS = 50_000
# Positions of a result that come back from one task in one row.
BLOCK = 1 << 16
# Up to this many positions that occur, the driver holds vectors of them.
HELD_POSITIONS = 100_000
# Positions of more than 1/FREQUENT of the rows are in the part of an elimination that the driver solves, and so are others, where a
# row would be left with two of them. There are never more than MOST_FREQUENT.
FREQUENT, MOST_FREQUENT = 1000, 1024
# Rows that a task makes dense at once, in the frequent positions alone.
DENSE_ROWS = 2048
# Rows without any other element are spread over this many keys.
SPREAD_KEYS = 1000


def entries(vector: str) -> tuple[Column, Column]:
    """Positions and values of the stored elements of a vector; nothing is made dense."""
    stored = F.unwrap_udt(vector)
    return F.coalesce(stored["indices"], F.sequence(F.lit(0), F.size(stored["values"]) - 1)), stored["values"]


def with_entries(rows: DataFrame, vector: str, *keep: Column) -> DataFrame:
    """(position, value) of the stored elements of each row's vector, with the columns to `keep`."""
    return _unzipped(rows, entries(vector), *keep)


def _unzipped(rows: DataFrame, stored: tuple[Column, Column], *keep: Column) -> DataFrame:
    positions, values = stored
    pairs = F.arrays_zip(positions.alias("position"), values.alias("value"))
    return rows.select(*keep, F.inline(pairs))


def _moments(rows: DataFrame, stored: tuple[Column, Column], target: Column, error: Column) -> tuple[dict, DataFrame]:
    """Count, sums and deviation over the rows, and sums by position from one aggregate over the stored elements."""
    totals = rows.agg(
        F.count("*").alias("n"), F.avg(target).alias("mean"), F.stddev_pop(target).alias("deviation"), F.sum(error).alias("error")
    ).first().asDict()
    sums = _unzipped(rows, stored, error.alias("_error")).groupBy("position").agg(
        F.sum("value").alias("x"), F.sum(F.col("value") ** 2).alias("xx"), F.sum(F.col("value") * F.col("_error")).alias("xe"),
        F.count_if(F.col("value") != 0).alias("times"),
    )
    return totals, sums


def check_optimum(
    rows: DataFrame, vector: str, target: str, prediction: str, coefficients, penalty: float, share: float, tolerance: float
) -> DataFrame:
    """(position, coefficient, gradient, met) of each element of a fitted linear model's vector.

    The model minimises half the mean squared error of standardised columns plus penalty / deviation of the target times
    (share |b| + (1 - share) b^2 / 2). That is the case where the gradient of the error balances the penalty: equal
    to it where a coefficient is not zero, at most `share` of it where it is. `met` says so for each position, within `tolerance`.
    The errors of rows with an intercept add up to zero, so the columns need not be centred and no vector is made dense.
    """
    error = F.col(target) - F.col(prediction)
    totals, sums = _moments(rows, entries(vector), F.col(target), error)
    n, deviation = totals["n"], totals["deviation"]
    spark = rows.sparkSession
    known = _known(spark, coefficients)
    columns = spark.range(len(coefficients)).withColumnRenamed("id", "position")
    mean = F.coalesce("x", F.lit(0.0)) / n
    spread = F.sqrt(F.greatest(F.coalesce("xx", F.lit(0.0)) / n - mean**2, F.lit(0.0)))
    joined = (
        columns.join(known, "position", "left").join(sums, "position", "left")
        .withColumns({"coefficient": F.coalesce("coefficient", F.lit(0.0)), "spread": spread, "mean": mean})
        .withColumns(
            {
                "slope": F.col("coefficient") * F.col("spread") / deviation,
                "gradient": F.try_divide(
                    F.coalesce("xe", F.lit(0.0)) - F.col("mean") * totals["error"], F.col("spread") * (n * deviation)
                ),
            }
        )
    )
    bound = penalty / deviation
    pull = F.col("gradient") - bound * (1 - share) * F.col("slope")
    met = (
        F.when(F.col("spread") <= 1e-9 * F.abs("mean"), F.abs("coefficient") < tolerance)
        .when(F.abs("slope") > 1e-9, F.abs(pull - bound * share * F.signum("slope")) <= tolerance)
        .otherwise(F.abs("gradient") <= bound * share + tolerance)
    )
    return joined.select("position", "coefficient", F.coalesce("gradient", F.lit(0.0)).alias("gradient"), met.alias("met"))


def _nonzero(coefficients: DenseVector | SparseVector) -> tuple[np.ndarray, np.ndarray]:
    """Positions, in order, and values of the elements that are not zero."""
    if isinstance(coefficients, SparseVector):
        kept = coefficients.values != 0
        return coefficients.indices[kept].astype(np.int64), coefficients.values[kept]
    values = coefficients.toArray()
    place = np.flatnonzero(values)
    return place, values[place]


@dataclass(frozen=True)
class TableCoefficients:
    """Coefficients of more positions than the driver holds: those of the frequent ones, and a table (position, coefficient) of the others."""

    frequent: SparseVector
    others: DataFrame

    def __len__(self) -> int:
        return len(self.frequent)


def _known(spark: SparkSession, coefficients: DenseVector | SparseVector | TableCoefficients) -> DataFrame:
    """(position, coefficient) of the coefficients that are not zero."""
    table = isinstance(coefficients, TableCoefficients)
    place, fitted = _nonzero(coefficients.frequent if table else coefficients)
    known = spark.createDataFrame(pa.table({"position": pa.array(place, pa.int64()), "coefficient": pa.array(fitted)}))
    return known.unionByName(coefficients.others.where("coefficient <> 0")) if table else known


@dataclass(frozen=True)
class RidgeModel:
    """A fitted linear model."""

    coefficients: DenseVector | SparseVector | TableCoefficients
    intercept: float
    steps: int
    features: str
    prediction: str

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds the prediction; the coefficients that are not zero go to the tasks once, as one broadcast.

        Those in a table are joined instead, to the elements at their positions, for which the rows are written once with a number each.
        """
        table = isinstance(self.coefficients, TableCoefficients)
        shared = rows.sparkSession.sparkContext.broadcast(_nonzero(self.coefficients.frequent if table else self.coefficients))
        intercept = self.intercept

        @F.arrow_udf("double")
        def predict(positions: pa.Array, values: pa.Array) -> pa.Array:
            place, fitted = shared.value
            positions, values, bounds = _lists(positions, values)
            at = np.searchsorted(place, positions)
            at[at == len(place)] = 0
            weights = np.where(place[at] == positions, fitted[at], 0.0) if len(place) else np.zeros(len(positions))
            return pa.array(_row_sums(values * weights, bounds) + intercept)

        score = predict(*entries(self.features))
        if not table:
            return rows.withColumn(self.prediction, score)
        number, part = "_row", "_others"
        while {number, part} & set(rows.columns):
            number, part = number + "_", part + "_"
        path = fresh_path(rows.sparkSession, "rows-to-score")
        rows.withColumn(number, F.monotonically_increasing_id()).write.parquet(path)
        rows = rows.sparkSession.read.parquet(path)
        frequent = [int(p) for p in self.coefficients.frequent.indices]
        others = with_entries(rows, self.features, F.col(number)).where(~F.col("position").isin(frequent))
        sums = others.join(self.coefficients.others, "position").groupBy(number).agg(F.sum(F.col("value") * F.col("coefficient")).alias(part))
        total = score + F.coalesce(part, F.lit(0.0))
        return rows.join(sums, number, "left").withColumn(self.prediction, total).drop(number, part)


def _lists(positions: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, values and row bounds of two list columns."""
    bounds = positions.offsets.to_numpy() - positions.offsets[0].as_py()
    return positions.flatten().to_numpy(), values.flatten().to_numpy(), bounds


def _row_sums(products: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0.0], np.cumsum(products)])
    return running[bounds[1:]] - running[bounds[:-1]]


def _products(rows: DataFrame, width: int, weights: np.ndarray, offset: float) -> tuple[np.ndarray, float]:
    """Xᵀu and the sum of u, with u = X weights - offset: one aggregate over the stored elements.

    Positions are those of the elements that occur in the rows, numbered from 0 (see `_numbered`). A task holds the weights
    and one partial result; both are as long as there are such elements.
    """
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, result = 0.0, np.zeros(width)
        for batch in batches:
            positions, values, bounds = _lists(batch.column(0), batch.column(1))
            scores = _row_sums(values * shared.value[positions], bounds) - offset
            total += float(scores.sum())
            result += np.bincount(positions, values * np.repeat(scores, np.diff(bounds)), width)
        yield from _blocks(np.append(result, total))

    try:
        result = _added(rows.select("positions", "values").mapInArrow(run, "low long, part binary"), width + 1)
    finally:
        shared.unpersist()
    return result[:width], float(result[width])


def _blocks(result: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The partial result of a task in rows of BLOCK positions."""
    for low in range(0, len(result), BLOCK):
        part = result[low : low + BLOCK]
        yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([part.tobytes()], pa.binary())], ["low", "part"])


def _added(partial: DataFrame, length: int) -> np.ndarray:
    """The sum of the partial results of all tasks, each block added up by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for low, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(part)
                sums[low] = sums[low] + part if low in sums else part
        for low, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([part.tobytes()], pa.binary())], ["low", "part"])

    result = np.zeros(length)
    for row in partial.repartition(1 + length // BLOCK, "low").mapInArrow(run, "low long, part binary").collect():
        part = np.frombuffer(row["part"])
        result[row["low"] : row["low"] + len(part)] = part
    return result


def _numbered(rows: DataFrame, place: np.ndarray) -> DataFrame:
    """`positions` and `values` of the rows, each position replaced by its number in `place`, which holds them all."""
    shared = rows.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            positions, values, bounds = _lists(batch.column(0), batch.column(1))
            numbers = pa.array(np.searchsorted(shared.value, positions).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds.astype(np.int32), part) for part in (numbers, pa.array(values))]
            yield pa.RecordBatch.from_arrays(lists, ["positions", "values"])

    return rows.select("positions", "values").mapInArrow(run, "positions array<int>, values array<double>")


def _scales(n: int, x: np.ndarray, xx: np.ndarray) -> np.ndarray:
    """One over the deviation of each column; zero for a constant one."""
    mean = x / n
    spread = np.sqrt(np.maximum(xx / n - mean**2, 0))
    return np.where(spread > 1e-9 * np.abs(mean), np.divide(1, spread, where=spread > 0, out=np.zeros(len(x))), 0.0)


def _crowded(rows: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(position) of each element outside `frequent` that is not alone in its row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            positions, values, bounds = _lists(batch.column(0), batch.column(1))
            other = (values != 0) & ~np.isin(positions, frequent)
            row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[other]
            together = np.bincount(row, minlength=1)[row] > 1
            yield pa.RecordBatch.from_arrays([pa.array(positions[other][together].astype(np.int64))], ["position"])

    return rows.select("positions", "values").mapInArrow(run, "position long")


def _separating(rows: DataFrame, sums: DataFrame, n: int) -> np.ndarray | None:
    """Positions, at most MOST_FREQUENT and in order, outside which no row has two elements, if there are so few.

    They are the frequent ones, and of the others those that meet most often: a rare label of a small category meets a
    label of a wide one in each of its rows, which a label of the wide one does in few.
    """
    often = sums.where(F.col("times") * FREQUENT > n).orderBy(F.desc("times"), "position").limit(MOST_FREQUENT)
    place = often.toArrow()["position"].to_numpy()
    met = _crowded(rows, place).groupBy("position").agg(F.count("*").alias("rows"))
    # one more than there is room for, so that a meeting is seen where there is no room
    more = met.orderBy(F.desc("rows"), "position").limit(MOST_FREQUENT - len(place) + 1).toArrow()["position"].to_numpy()
    if len(more) and len(place) == MOST_FREQUENT:
        return None
    more = more[: MOST_FREQUENT - len(place)]
    place = np.sort(np.concatenate([place, more]).astype(np.int64))
    # none met: one pass has shown it
    return place if not len(more) or _crowded(rows, place).count() == 0 else None


def _arranged(rows: DataFrame, place: np.ndarray) -> DataFrame:
    """The rows in the order of their one element outside `place`: (other, mark, numbers, values, target).

    `other` and `mark` are its position and value, `numbers` and `values` the elements at `place`, numbered. A row without
    such an element has a mark of 0 and a negative key, by its content, so that many of them are not one task's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            positions, values, bounds = _lists(batch.column(0), batch.column(1))
            target = batch.column(2).to_numpy()
            row = np.repeat(np.arange(len(target)), np.diff(bounds))
            number, known = np.searchsorted(place, positions), np.isin(positions, place)
            content = (target + _row_sums(values * (positions + 1), bounds)).view(np.uint64)
            other = -1 - ((content * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % SPREAD_KEYS
            mark = np.zeros(len(target))
            rest = ~known & (values != 0)
            other[row[rest]], mark[row[rest]] = positions[rest], values[rest]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[known], minlength=len(target)))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(a)) for a in (number[known].astype(np.int32), values[known])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(other), pa.array(mark), *lists, pa.array(target)], ["other", "mark", "numbers", "values", "target"]
            )

    schema = "other long, mark double, numbers array<int>, values array<double>, target double"
    split = rows.select("positions", "values", F.col("_target").alias("target")).mapInArrow(run, schema)
    return split.repartition("other").sortWithinPartitions("other")


@dataclass(frozen=True)
class _Elimination:
    """Least squares in which a row has at most one element outside the frequent positions.

    The columns of the others are then orthogonal, so each is eliminated by itself, and what is left is a system of the
    intercept and the frequent positions. Those are standardised, the others scaled and not centred, which an intercept makes no matter.
    """

    place: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    centre: float
    n: int
    ridge: float

    @property
    def size(self) -> int:
        return 1 + len(self.place)

    def dense(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """`other`, mark, the standardised frequent columns behind a one, and the centred target, a few rows at a time."""
        for batch in batches:
            for low in range(0, batch.num_rows, DENSE_ROWS):
                part = batch.slice(low, DENSE_ROWS)
                numbers, values, bounds = _lists(part.column(2), part.column(3))
                x = np.zeros((part.num_rows, len(self.place)))
                x[np.repeat(np.arange(part.num_rows), np.diff(bounds)), numbers] = values
                z = np.concatenate([np.ones((part.num_rows, 1)), (x - self.mean) * self.scale], axis=1)
                other, mark, target = (part.column(c).to_numpy() for c in (0, 1, 4))
                yield other, mark, z, target - self.centre

    def groups(self, other: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each other column: its position, scale, products with the frequent columns and the target, and its own square."""
        kept = other >= 0
        other, sums = other[kept], sums[kept]
        scale = _scales(self.n, sums[:, -2], sums[:, -1])
        by = (scale / self.n)[:, None]
        square = sums[:, -1] * scale**2 / self.n + self.ridge
        return other, scale, sums[:, : self.size] * by, sums[:, self.size] * by[:, 0], np.where(scale > 0, square, 1.0)

    def summed(self, batches: Iterator[pa.RecordBatch], each=lambda z, y: None) -> Iterator[tuple[np.ndarray, ...]]:
        """`groups` of rows in the order of `other`; `each` sees all rows."""
        held = None  # the last key and its sums, which the next rows may add to
        for other, mark, z, y in self.dense(batches):
            each(z, y)
            rows = np.concatenate([z * mark[:, None], (y * mark)[:, None], mark[:, None], (mark**2)[:, None]], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], other[1:] != other[:-1]]))
            keys, sums = other[starts], np.add.reduceat(rows, starts)
            if held is not None and held[0] == keys[0]:
                sums[0] += held[1]
            elif held is not None:
                keys, sums = np.concatenate([[held[0]], keys]), np.concatenate([held[1][None], sums])
            held = keys[-1], sums[-1]
            yield self.groups(keys[:-1], sums[:-1])
        if held is not None:
            yield self.groups(np.array([held[0]]), held[1][None])

    def solve(self, arranged: DataFrame) -> np.ndarray:
        """The intercept and the frequent positions, in their own scales: one pass, then a small system on the driver."""
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matrix, right = np.zeros((size, size)), np.zeros(size)

            def each(z: np.ndarray, y: np.ndarray) -> None:
                nonlocal matrix, right
                matrix += z.T @ z / self.n
                right += y @ z / self.n

            for _, _, cross, product, square in self.summed(batches, each):
                matrix -= cross.T @ (cross / square[:, None])
                right -= (product / square) @ cross
            yield from _blocks(np.append(matrix.ravel(), right))

        found = _added(arranged.mapInArrow(run, "low long, part binary"), size * size + size)
        matrix, right = found[: size * size].reshape(size, size), found[size * size :]
        matrix = (matrix + matrix.T) / 2 + np.diag([0.0, *[self.ridge] * len(self.place)])
        values, vectors = np.linalg.eigh(matrix)
        # the diagonal was of ones before the elimination; what is nothing beside them has no solution of its own
        inverse = np.divide(1, values, where=values > 1e-12, out=np.zeros(size))
        return vectors @ (inverse * (vectors.T @ right))

    def others(self, arranged: DataFrame, solution: np.ndarray) -> DataFrame:
        """(position, coefficient) of the other positions, from a second pass."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for other, scale, cross, product, square in self.summed(batches):
                fitted = (product - cross @ solution) / square * scale
                yield pa.RecordBatch.from_arrays([pa.array(other), pa.array(fitted)], ["position", "coefficient"])

        return arranged.mapInArrow(run, "position long, coefficient double")


def _eliminate(
    rows: DataFrame, sums: DataFrame, totals: dict, width: int, penalty: float, features: str, prediction: str
) -> RidgeModel | None:
    """The model by elimination, if few positions leave no row with two elements outside them."""
    n, centre = totals["n"], totals["mean"]
    place = _separating(rows, sums, n)
    if place is None:
        return None
    known = sums.where(F.col("position").isin(place.tolist())).orderBy("position").toArrow()
    x, xx = (known[c].to_numpy() for c in ("x", "xx"))
    system = _Elimination(place, x / n, _scales(n, x, xx), centre, n, penalty / totals["deviation"])
    arranged = _arranged(rows, system.place).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        solution = system.solve(arranged)
        path = fresh_path(rows.sparkSession, "coefficients")
        system.others(arranged, solution).write.parquet(path)
    finally:
        arranged.unpersist()
    fitted = solution[1:] * system.scale
    others = rows.sparkSession.read.parquet(path)
    coefficients = TableCoefficients(SparseVector(width, system.place, fitted), others)
    return RidgeModel(coefficients, centre + float(solution[0] - fitted @ system.mean), 1, features, prediction)


def fit_ridge(
    train: DataFrame,
    features: str,
    target: str,
    penalty: float,
    prediction: str = "prediction",
    tolerance: float = 1e-5,
    steps: int = MAX_STEPS,
) -> RidgeModel:
    """Least squares with `penalty` / deviation of the target times half the squared standardised coefficients.

    The normal equations of the standardised columns are solved by conjugate gradients: every step is one pass over
    the stored elements of the rows, and the matrix of the equations, with its cell for each pair of
    features, is never built. It ends when no position is off the optimum by more than `tolerance`, in units of a correlation. What the driver and a task hold is as long as
    there are elements in the rows that are ever set, whatever the width of the vector. Beyond HELD_POSITIONS of them, rows with
    at most one element outside 1024 positions are solved by elimination instead, and nothing as long is held anywhere. Rows with a null target or vector
    are left out. Without rows, or where all targets are equal, the coefficients are zero.
    """
    positions, values = entries(features)
    stored = F.unwrap_udt(features)
    # the elements once, and not the vector they are from
    rows = train.where(F.col(features).isNotNull() & F.col(target).isNotNull()).select(
        F.col(target).cast("double").alias("_target"), positions.alias("positions"), values.alias("values"),
        F.coalesce(stored["size"], F.size(stored["values"])).alias("size"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    numbered = sums = None
    try:
        width = rows.agg(F.max("size")).first()[0] or 0
        totals, sums = _moments(rows, (F.col("positions"), F.col("values")), F.col("_target"), F.col("_target"))
        n, centre, deviation = totals["n"], totals["mean"] or 0.0, totals["deviation"] or 0.0
        sums = sums.persist(StorageLevel.MEMORY_AND_DISK)
        occurring = sums.count()
        if n == 0 or deviation == 0 or occurring == 0:
            return RidgeModel(Vectors.sparse(width, []), centre, 0, features, prediction)
        if occurring > HELD_POSITIONS:
            eliminated = _eliminate(rows, sums, totals, width, penalty, features, prediction)
            if eliminated is not None:
                return eliminated
        by_position = sums.orderBy("position").toArrow()  # one row per element that occurs
        place, x, xx, xy = (by_position[c].to_numpy() for c in ("position", "x", "xx", "xe"))
        numbered = _numbered(rows, place).coalesce(1 + n // STEP_ROWS).persist(StorageLevel.MEMORY_AND_DISK)
        mean, scale = x / n, _scales(n, x, xx)
        ridge = penalty / deviation

        solution = np.zeros(len(place))
        residual = (xy / n - mean * centre) * scale / deviation
        direction, size = residual.copy(), residual @ residual
        done = 0
        while np.abs(residual).max() > tolerance and done < steps:
            weights = direction * scale
            product, total = _products(numbered, len(place), weights, float(mean @ weights))
            moved = (product - mean * total) / n * scale + ridge * direction
            length = size / (direction @ moved)
            solution += length * direction
            residual -= length * moved
            before, size = size, residual @ residual
            direction = residual + size / before * direction
            done += 1
        coefficients = solution * scale * deviation
        fitted = SparseVector(width, place, coefficients)
        return RidgeModel(fitted, centre - float(mean @ coefficients), done, features, prediction)
    finally:
        for held in (numbered, sums, rows):
            if held is not None:
                held.unpersist()
