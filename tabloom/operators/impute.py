"""Filling missing values: the most common text, the mean number."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tabloom.functions.missing import is_missing_text, number_or_null
from tabloom.operators.profile import most_common_value, value_counts

IMPUTED = "_imp"


def mode_values(counts: DataFrame) -> dict[str, str]:
    """column -> most common value, from value counts; one row per column reaches the driver."""
    return {row["column"]: row["value"] for row in most_common_value(counts).collect()}


def fill_mode(df: DataFrame, modes: Mapping[str, str]) -> DataFrame:
    return df.withColumns(
        {c: F.when(is_missing_text(c), F.lit(v)).otherwise(F.col(c)) for c, v in modes.items()}
    )


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and sentinel become the column's most common value; one pass finds all of them."""
    return fill_mode(df, mode_values(value_counts(df, columns)))


def mean_values(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """column -> mean of its numbers, in one pass; None where a column holds none."""
    return df.agg(*(F.avg(number_or_null(c)).alias(c) for c in columns)).first().asDict()


def fill_mean(df: DataFrame, means: Mapping[str, float]) -> DataFrame:
    """Add `<column>_imp` with the mean in place of null and NaN."""
    return df.withColumns(
        {c + IMPUTED: F.coalesce(number_or_null(c), F.lit(v)) for c, v in means.items()}
    )


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    means = mean_values(df, columns)
    empty = [c for c, v in means.items() if v is None]
    if empty:
        raise ValueError(f"no mean to impute, every value is missing: {', '.join(empty)}")
    return fill_mean(df, means)
