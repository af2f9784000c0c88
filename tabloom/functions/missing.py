"""Predicates for the three forms of a missing value: null, sentinel text, NaN."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabloom.config import SENTINEL


def is_sentinel(column: str) -> Column:
    """Text equals the sentinel; false (never null) on null input."""
    return F.col(column).eqNullSafe(F.lit(SENTINEL))


def is_missing_text(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == SENTINEL)


def to_double(column: str) -> Column:
    """Typed value; text that is no number becomes null."""
    return F.col(column).try_cast("double")


def number_or_null(column: str | Column) -> Column:
    """The number, with NaN turned into null so that aggregates skip it."""
    value = to_double(column) if isinstance(column, str) else column
    return F.when(~F.isnan(value), value)
