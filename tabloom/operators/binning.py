"""Numbers cut into a few bins each, found once for all columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from tabloom.operators.features import assemble

PRECISION = 0.001


@dataclass(frozen=True)
class Bins:
    """The inner bounds of the bins of each column."""

    bounds: Mapping[str, Sequence[float]]

    def number(self, df: DataFrame, prefix: str = "_bin") -> tuple[DataFrame, list[str]]:
        """`df` with the bin number of each column, and the names of the new columns."""
        names = {c: f"{prefix}{i}" for i, c in enumerate(self.bounds)}
        infinite = float("inf")
        splits = [[-infinite, *(self.bounds[c] or [0.0]), infinite] for c in names]
        binned = Bucketizer(inputCols=list(names), outputCols=list(names.values()), splitsArray=splits).transform(df)
        # The bucketizer calls its numbers names of classes; here their order counts.
        return binned.withColumns({n: F.col(n).alias(n, metadata={}) for n in names.values()}), list(names.values())

    def vector(self, df: DataFrame, output: str) -> DataFrame:
        """`df` with one vector of all bin numbers in place of the columns."""
        binned, names = self.number(df)
        return assemble(binned, names, output).drop(*names, *self.bounds)


def fit_bins(df: DataFrame, columns: Sequence[str], bins: int, precision: float = PRECISION) -> Bins:
    """Bins of about equal numbers of rows, in one pass over all columns; at most `bins` - 1 bounds a column reach the driver."""
    shares = [i / bins for i in range(1, bins)]
    quantiles = df.approxQuantile(list(columns), shares, precision)
    return Bins({c: sorted(set(q)) for c, q in zip(columns, quantiles, strict=True)})
