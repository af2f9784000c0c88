"""Looking at rows and schemas, as DataFrames."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F


def preview_rows(df: DataFrame, n: int = 20, *, key: str) -> DataFrame:
    """The first `n` rows by `key`: a per-partition top-n, never a full sort."""
    return df.orderBy(key).limit(n)


def preview_full_vectors(df: DataFrame, vector: str, n: int = 10, *, key: str) -> DataFrame:
    """The first `n` vectors in full, as arrays; only those rows are converted."""
    return preview_rows(df.select(key, vector), n, key=key).select(
        key, vector_to_array(vector).alias(vector)
    )


def describe_schema(df: DataFrame) -> DataFrame:
    """(pos, name, type, present): the schema with the non-null count of each column, in one pass."""
    fields = [
        F.struct(
            F.lit(pos).cast("bigint").alias("pos"),
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.count(F.col(f"`{field.name}`")).alias("present"),
        )
        for pos, field in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*fields).alias("fields")).select(F.inline("fields"))
