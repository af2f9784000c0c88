"""Global positions without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.session import shared_folder

# Hex digits of a digest that name its range: 65,536 ranges.
PREFIX_DIGITS = 4


def with_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Number the rows 1..n in the given order.

    The range-partitioned sort leaves partition i entirely before partition
    i+1, so a row's position is its offset inside its partition plus the rows
    of all earlier partitions. The checkpoint freezes the sorted layout, so
    both reads below see the same partitions even after an executor is lost.
    The broadcast side has one row per sort partition.
    """
    shared_folder(df.sparkSession)
    columns = df.columns
    frozen = (
        df.orderBy(*order)
        .withColumn("_part", F.spark_partition_id())
        # low 33 bits: row number inside the partition
        .withColumn("_seq", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .checkpoint()
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        frozen.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return frozen.join(F.broadcast(offsets), "_part").select(
        *(F.col(f"`{c}`") for c in columns), (F.col("_before") + F.col("_seq") + 1).alias(name)
    )


def with_digest_position(df: DataFrame, digest: Column, *ties: Column, name: str = "position") -> DataFrame:
    """Number the rows 1..n in the order of a uniform hex digest: one shuffle, no sampled ranges and no copy.

    Because the digest is uniform, its first hex digits are even ranges. One scan counts the rows of each; the rows before
    a range are a running sum over at most 16 ** PREFIX_DIGITS counts, which is broadcast, and a window inside the
    range does the rest. Rows of equal digest and ties share a range.
    """
    prefix = F.substring(digest, 1, PREFIX_DIGITS)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.select(prefix.alias("_range")).groupBy("_range").agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_range").orderBy("_digest", *ties)
    numbered = (
        df.withColumns({"_digest": digest, "_range": prefix})
        .withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")
    )
    return numbered.select(*(F.col(f"`{c}`") for c in df.columns), (F.col("_before") + F.col("_place")).alias(name))
