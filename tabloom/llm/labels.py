"""Bounded samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import fold

FOLDS = 5  # rows of fold 0 are held out


def held_out(id_column: Column) -> Column:
    """True where the crc32 of the id as text is 0 modulo FOLDS; rows without an id are held out too."""
    return F.coalesce(fold(id_column, FOLDS) == 0, F.lit(True))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, limit: int, *, id_col: str, text_col: str
) -> DataFrame:
    """(id, text, label, part): at most `limit` labelled rows that are not held out.

    Rows are taken in the order of a hash of the id, so the sample is the same in every layout. Of repeated labels of
    one id the largest counts, of repeated texts that of the smallest hash. `part` is a second hash in [0, 100). The labels broadcast are `limit` rows at most.
    """
    usable = labels.where(~held_out(F.col(id_col)) & F.col(label_col).isNotNull())
    chosen = (
        usable.groupBy(F.col(id_col).alias("id"))
        .agg(F.max(F.col(label_col)).cast("int").alias("label"))
        .orderBy(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), "id")
        .limit(limit)
        .withColumn("part", F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("part")), F.lit(100)).cast("int"))
    )
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = F.min_by(F.struct("text", "label", "part"), F.struct(F.xxhash64("text"), "text"))
    return texts.join(F.broadcast(chosen), "id").groupBy("id").agg(one.alias("_one")).select("id", "_one.*")
