"""Row hash: a reproducible stand-in for a random draw.

`randomSplit` and `sample` depend on how rows are laid out over partitions, so
the same seed gives other rows after a repartition or a lost executor. A hash
of the row key gives the same rows under any layout and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_RANGE = 1 << 60


def row_digest(salt: str, key: str | Column) -> Column:
    """All 128 bits of the hash, as hex digits: for orders, where equal draws would show."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(key.cast("string"), F.lit(""))))


def row_hash(salt: str, key: str | Column) -> Column:
    """Hash of `key` in [0, HASH_RANGE), independent for each salt."""
    return F.conv(F.substring(row_digest(salt, key), 1, 15), 16, 10).cast("bigint")


def threshold(fraction: float) -> int:
    """Number of hash values that make up `fraction` of the range."""
    return int(fraction * HASH_RANGE)


def hash_below(salt: str, key: str | Column, fraction: float) -> Column:
    """True for about `fraction` of the keys."""
    return row_hash(salt, key) < F.lit(threshold(fraction))


def with_row_key(df, name: str = "row_id"):
    """Add a key made of the whole row, for tables that have none; equal rows share it."""
    return df.withColumn(name, F.md5(F.concat_ws("\x1f", *(
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in df.columns
    ))))
