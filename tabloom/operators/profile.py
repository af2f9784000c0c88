"""Counts, class balance, missing rates, value distributions.

Each profile is one pass over the table for all columns together: every task
sends one partial row (or one row per distinct value), however many rows it read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.config import MISSING_LIMIT_PCT, SENTINEL
from tabloom.functions.missing import is_missing_text, is_sentinel, number_or_null, to_double


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(label) == 0).alias("zeros"), F.count_if(F.col(label) == 1).alias("ones")
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """(zeros, ones, imbalance = ones / zeros); null ratio without zeros."""
    return class_counts(df, label).withColumn(
        "imbalance", F.try_divide(F.col("ones").cast("double"), F.col("zeros").cast("double"))
    )


def imbalance_factor(df: DataFrame, label: str) -> DataFrame:
    """(zeros, ones, factor): zeros per one, truncated, at least 1; null without ones."""
    ratio = F.floor(F.try_divide(F.col("zeros").cast("double"), F.col("ones").cast("double")))
    return class_counts(df, label).withColumn(
        "factor", F.when(F.col("ones") > 0, F.greatest(F.lit(1), ratio).cast("bigint"))
    )


def _per_column(df: DataFrame, columns: Sequence[str], measures) -> DataFrame:
    """One aggregate row turned into one row per column."""
    parts = [
        F.struct(F.lit(c).alias("column"), *(m.alias(name) for name, m in measures(c).items()))
        for c in columns
    ]
    return df.agg(F.count("*").alias("row_count"), F.array(*parts).alias("parts")).select(
        "row_count", F.inline("parts")
    )


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def missing_rate_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, row_count, nulls, sentinels, missing_pct)."""
    counts = _per_column(
        df,
        columns,
        lambda c: {"nulls": F.count_if(F.col(c).isNull()), "sentinels": F.count_if(is_sentinel(c))},
    )
    missing = F.col("nulls") + F.col("sentinels")
    return counts.select(
        "column", "row_count", "nulls", "sentinels", _share(missing, F.col("row_count")).alias("missing_pct")
    )


def missing_rate_from_counts(counts: DataFrame) -> DataFrame:
    """(column, row_count, missing_pct) from value counts, without another scan of the table."""
    return category_summary(counts).select(
        "column", "row_count", _share(F.col("missing"), F.col("row_count")).alias("missing_pct")
    )


def continuous_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, row_count, nulls, sentinels, nans, mean, missing_pct) of text columns read as numbers.

    `nulls` are the rows without a number after the cast; `sentinels` says how
    many of those were the sentinel text, so the rate counts each row once.
    """
    # each value is cast once, below the aggregate
    typed = df.select(*columns, *(to_double(c).alias(f"{c}_number") for c in columns))
    counts = _per_column(
        typed,
        columns,
        lambda c: {
            "nulls": F.count_if(F.col(f"{c}_number").isNull()),
            "sentinels": F.count_if(F.col(c).cast("string").eqNullSafe(F.lit(SENTINEL))),
            "nans": F.count_if(F.isnan(f"{c}_number")),
            "mean": F.avg(number_or_null(F.col(f"{c}_number"))),
        },
    )
    missing = F.col("nulls") + F.col("nans")
    return counts.withColumn("missing_pct", _share(missing, F.col("row_count")))


def missing_rate_continuous(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, row_count, nulls, sentinels, nans, missing_pct)."""
    return continuous_profile(df, columns).drop("mean")


def prune_by_missing_rate(rates: DataFrame, limit: float = MISSING_LIMIT_PCT) -> DataFrame:
    """(column, missing_pct, keep): keep a column below the limit."""
    return rates.select("column", "missing_pct", (F.col("missing_pct") < limit).alias("keep"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count) of every distinct value of every column; null is a value.

    One scan for all columns. The unpivoted rows never leave their task: they
    meet the partial aggregate first, so a hot value is one row per task.
    """
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    return (
        df.select(*texts)
        .unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("count"))
    )


def category_summary(counts: DataFrame) -> DataFrame:
    """(column, row_count, missing, labels, mode, mode_count) from value counts, without another scan.

    `labels` counts the distinct present values; `mode` is the most frequent of
    them, the smallest on a tie, and null for a column without values.
    """
    present = ~is_missing_text("value")
    best = F.min(F.when(present, F.struct((-F.col("count")).alias("less"), F.col("value").alias("value"))))
    return (
        counts.groupBy("column")
        .agg(
            F.sum("count").alias("row_count"),
            F.sum(F.when(present, 0).otherwise(F.col("count"))).alias("missing"),
            F.count_if(present).alias("labels"),
            best.alias("best"),
        )
        .select(
            "column", "row_count", "missing", "labels",
            F.col("best.value").alias("mode"), (-F.col("best.less")).alias("mode_count"),
        )
    )


def most_common_value(counts: DataFrame) -> DataFrame:
    """(column, value, count) of the most frequent present value; a column without values has no row."""
    return (
        category_summary(counts)
        .filter(F.col("mode").isNotNull())
        .select("column", F.col("mode").alias("value"), F.col("mode_count").alias("count"))
    )
