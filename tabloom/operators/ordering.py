"""Sorts and top-1."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.functions.hashing import row_digest
from tabloom.functions.ranking import with_digest_position, with_position


def sort_by_count(counts: DataFrame) -> DataFrame:
    """Value counts, rarest first within each column, numbered over the whole table."""
    return with_position(counts, F.col("column"), F.col("count"), F.col("value").asc_nulls_first())


def top_1(counts: DataFrame) -> DataFrame:
    """The last row of each column's ascending sort, found by an aggregate; the smallest value wins a tie."""
    best = F.min(F.struct((-F.col("count")).alias("less"), F.col("value").isNull().alias("none"), "value"))
    return counts.groupBy("column").agg(best.alias("best")).select(
        "column", F.col("best.value").alias("value"), (-F.col("best.less")).alias("count")
    )


def shuffle_rows(df: DataFrame, key: str, salt: str = "shuffle") -> DataFrame:
    """A reproducible permutation: rows in order of the hash of their key, numbered from 1."""
    return with_digest_position(df, row_digest(salt, key), F.col(key))


def shuffle_rows_rng(df: DataFrame, seed: int) -> DataFrame:
    """The generator-based shuffle; which order comes out depends on the input's layout."""
    return df.orderBy(F.rand(seed))
