"""Row filters; each stays a plain predicate that Catalyst can push to the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.config import CLAIMS, SENTINEL


def filter_equals(df: DataFrame, column: str, value: float) -> DataFrame:
    return df.filter(F.col(column) == value)


def filter_is_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def filter_sentinel(df: DataFrame, column: str) -> DataFrame:
    """Rows holding the sentinel text; apply before the column is cast."""
    return df.filter(F.col(column) == SENTINEL)


def filter_is_nan(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.isnan(column))


def drop_any_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in every column (or every named one): no null, no NaN."""
    return df.dropna("any", subset=columns)


def missing_cells(df: DataFrame, key: str, categorical: Sequence[str], continuous: Sequence[str]) -> DataFrame:
    """(key, column, kind) of every unusable cell of all columns, in one pass over text columns.

    `kind` is `null`, `sentinel`, and in continuous columns `nan` or, for text that is no number, `text`.
    """

    def kind(column: str, number: bool) -> Column:
        cell = F.col(f"`{column}`")
        found = F.when(cell.isNull(), "null").when(cell == SENTINEL, "sentinel")
        if number:
            value = cell.try_cast("double")
            found = found.when(value.isNull(), "text").when(F.isnan(value), "nan")
        return F.struct(F.lit(column).alias("column"), found.alias("kind"))

    cells = [kind(c, False) for c in categorical] + [kind(c, True) for c in continuous]
    return df.select(key, F.inline(F.filter(F.array(*cells), lambda c: c["kind"].isNotNull())))


def train_positive(df: DataFrame, label: str = CLAIMS.label) -> DataFrame:
    return filter_equals(df, label, 1.0)


def predicted_positive(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    return filter_equals(scored, prediction, 1.0)
