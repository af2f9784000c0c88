"""Projections: rename, cast, select, drop, derive, replace."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tabloom.config import CLAIMS, SENTINEL
from tabloom.functions.missing import to_double


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def cast_double(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast the named columns (all by default) in one projection; bad text becomes null."""
    return df.withColumns({c: to_double(f"`{c}`") for c in (df.columns if columns is None else columns)})


def cast_double_once(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`cast_double` for a filter to follow: one that is moved below the cast would read the text a second time.

    No filter on generated columns is moved below the generator.
    """
    cast = F.inline(F.array(F.struct(*(to_double(f"`{c}`").alias(c) for c in columns))))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, cast).select(*(F.col(f"`{c}`") for c in df.columns))


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in columns))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the columns that exist; other names are ignored."""
    return df.drop(*columns)


def derive_binary_label(df: DataFrame, target: str = CLAIMS.target, label: str = CLAIMS.label) -> DataFrame:
    """1.0 where the target is a number above zero, else 0.0 (also for no number)."""
    return df.withColumn(label, F.when(number_above_zero(target), 1.0).otherwise(0.0))


def number_above_zero(column: str):
    # Spark orders NaN above every number; a NaN amount is no claim.
    value = to_double(column)
    return (value > 0) & ~F.isnan(value)


def replace_sentinel(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Put the given value in place of the sentinel; null stays null."""
    return df.withColumns(
        {c: F.when(F.col(c) == SENTINEL, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()}
    )


def fill_null_literal(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.fillna(dict(values))
