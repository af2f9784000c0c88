"""CSV scans with explicit schemas: every field arrives as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tabloom.config import CLAIMS_COLUMNS, SIGNAL_COLUMNS


def text_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def scan_csv_positional(
    spark: SparkSession, path: str, names: Sequence[str] = SIGNAL_COLUMNS
) -> DataFrame:
    """CSV without a header; columns are named by position."""
    return spark.read.schema(text_schema(names)).csv(path)


def scan_csv_header(
    spark: SparkSession, path: str, names: Sequence[str] | None = CLAIMS_COLUMNS
) -> DataFrame:
    """CSV with a header line.

    With `names` the file is opened once, by the scan, and a header that does
    not agree with them fails the read. `names=None` takes the names from the
    header, for files with further columns; the values are text either way.
    """
    reader = spark.read.option("header", True)
    if names is None:
        return reader.csv(path)
    return reader.schema(text_schema(names)).option("enforceSchema", False).csv(path)
