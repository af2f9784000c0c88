"""Splits, samples, class balancing and union.

All hash-based forms are filters: no shuffle, no count, the same rows in every
run and under every layout. The generator-based forms are kept as options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.config import SEED, SUBSAMPLE_FRACTION, TRAIN_FRACTION
from tabloom.functions.hashing import hash_below, row_hash
from tabloom.operators.profile import imbalance_factor


def split_train_test(
    df: DataFrame, key: str, fraction: float = TRAIN_FRACTION, salt: str = "split"
) -> tuple[DataFrame, DataFrame]:
    in_train = hash_below(salt, key, fraction)
    return df.filter(in_train), df.filter(~in_train)


def split_train_test_rng(
    df: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([fraction, 1 - fraction], seed)
    return train, test


def subsample_small(
    df: DataFrame, key: str, fraction: float = SUBSAMPLE_FRACTION, salt: str = "small"
) -> DataFrame:
    return df.filter(hash_below(salt, key, fraction))


def sample_fraction(df: DataFrame, key: str, fraction: float, salt: str = "under") -> DataFrame:
    """Sample without replacement."""
    return df.filter(hash_below(salt, key, fraction))


def sample_fraction_rng(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    return df.sample(False, fraction, seed)


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept; columns matched by name."""
    return first.unionByName(second)


def undersample_majority(
    df: DataFrame, key: str, label: str, factor: int | None = None, salt: str = "under"
) -> DataFrame:
    """All ones, and one in `factor` of the zeros, by one filter over one scan.

    Without `factor` a counting pass finds it: zeros per one, truncated.
    """
    if factor is None:
        factor = imbalance_factor(df, label).first()["factor"]
        if factor is None:
            raise ValueError(f"no row has {label} = 1: there is nothing to balance against")
    return df.filter(
        (F.col(label) == 1) | ((F.col(label) == 0) & hash_below(salt, key, 1 / factor))
    )


def with_fold(df: DataFrame, key: str, folds: int, salt: str = "fold") -> DataFrame:
    return df.withColumn("fold", (row_hash(salt, key) % folds).cast("int"))
