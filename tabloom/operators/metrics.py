"""Scores of predictions, as aggregate queries with one result row."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.session import fresh_path

# Distinct scores that one task ranks, about; buckets whose sums one task adds up.
BUCKET_SCORES = 1 << 18
BUCKETS_TOGETHER = 1 << 10


def positive_score(vector: str = "rawPrediction") -> Column:
    """The class-1 element of a classifier's score vector."""
    return vector_to_array(vector)[1]


def auc_roc(
    scored: DataFrame, label: str = "label", score: str = "score", bucket_scores: int = BUCKET_SCORES
) -> DataFrame:
    """Area under the ROC curve, exact with ties: the share of (1, 0) pairs ranked rightly.

    Rows with equal scores meet in the partial aggregate, so a hot score is one
    row per task. Each distinct score then needs the number of zeros scored
    lower. The distinct scores are dealt by range into as many buckets as hold about `bucket_scores` of them each: a window inside
    a bucket counts the zeros there. The zeros of all earlier buckets are added for a bucket as a whole, on
    two levels: inside runs of BUCKETS_TOGETHER buckets, then over the runs. The counts by score are
    written to the shared folder first, so the rows are scored once. Null when a
    class is absent.
    """
    rows = scored.select(F.col(label).alias("label"), F.col(score).cast("double").alias("score"))
    return _ranked(rows, bucket_scores).select("auc")


def by_score(rows: DataFrame, bucket_scores: int, *totals: str) -> DataFrame:
    """(score, ones, zeros, totals, bucket): one row per distinct score, in ranges of about `bucket_scores` of them."""
    spark = rows.sparkSession
    path = fresh_path(spark, "by-score")
    rows.groupBy("score").agg(
        F.count_if(F.col("label") == 1).cast("double").alias("ones"),
        F.count_if(F.col("label") == 0).cast("double").alias("zeros"),
        *(F.sum(t).alias(t) for t in totals),
    ).write.parquet(path)
    counts = spark.read.parquet(path)
    buckets = -(-counts.count() // bucket_scores)
    if buckets <= 1:
        return counts.withColumn("bucket", F.lit(0))
    # The number of a range is that of its partition; written, it stays what it is.
    path = fresh_path(spark, "by-score-ranges")
    counts.repartitionByRange(buckets, "score").withColumn("bucket", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def _ranked(rows: DataFrame, bucket_scores: int, *totals: str) -> DataFrame:
    """One row: the AUC of (label, score), and the sums of further columns on the way."""
    sums = [F.sum(t).alias(t) for t in totals]
    counts = by_score(rows, bucket_scores, *totals)
    inside = Window.partitionBy("bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("zeros").over(inside), F.lit(0.0))
    # one row per bucket from here on
    by_bucket = (
        counts.withColumn("won", F.col("ones") * (lower + F.col("zeros") / 2))
        .groupBy("bucket")
        .agg(F.sum("won").alias("won"), F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"), *sums)
        .withColumn("run", F.floor(F.col("bucket") / BUCKETS_TOGETHER))
    )
    by_run = _with_earlier(by_bucket, "bucket", "run").groupBy("run").agg(
        F.sum("won").alias("won"), F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"), *sums
    )
    return _with_earlier(by_run, "run").agg(
        F.try_divide(F.sum("won"), F.sum("ones") * F.sum("zeros")).alias("auc"), *sums
    )


def _with_earlier(parts: DataFrame, order: str, *within: str) -> DataFrame:
    """Adds the pairs that the ones of each part win against the zeros of all parts before it."""
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("zeros").over(before), F.lit(0.0))
    return parts.withColumn("won", F.col("won") + F.col("ones") * earlier)


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.agg(_accuracy(label, prediction))


def _accuracy(label: str, prediction: str) -> Column:
    return F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy")


def mse(scored: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    return scored.agg(_mse(target, prediction))


def mae(scored: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    return scored.agg(_mae(target, prediction))


def _mse(target: str, prediction: str) -> Column:
    return F.avg(F.pow(F.col(target) - F.col(prediction), 2)).alias("mse")


def _mae(target: str, prediction: str) -> Column:
    return F.avg(F.abs(F.col(target) - F.col(prediction))).alias("mae")


def classification_report(scored: DataFrame, label: str = "label") -> DataFrame:
    """(auc, accuracy, scored_rows) of a classifier's output.

    Model scoring is the costly part, so all three come from one pass over the
    scored rows.
    """
    rows = scored.select(
        F.col(label).alias("label"),
        positive_score().alias("score"),
        (F.col(label) == F.col("prediction")).cast("bigint").alias("right"),
        F.lit(1).cast("bigint").alias("scored_rows"),
    )
    accuracy_ = F.try_divide(F.col("right").cast("double"), F.col("scored_rows").cast("double"))
    return _ranked(rows, BUCKET_SCORES, "right", "scored_rows").select(
        "auc", accuracy_.alias("accuracy"), "scored_rows"
    )


def regression_report(scored: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """(mse, mae, scored_rows) in one pass."""
    return scored.agg(
        _mse(target, prediction), _mae(target, prediction), F.count("*").alias("scored_rows")
    )


def two_stage_report(
    applied: DataFrame, label: str, target: str, prediction: str = "combo_prediction"
) -> DataFrame:
    """(accuracy, mse, mae, scored_rows) of rows that went through both stages, in one pass.

    The accuracy covers all rows; errors and count only those predicted to be positive.
    """
    positive = F.col("prediction") == 1
    error = F.when(positive, F.col(target) - F.col(prediction))
    return applied.agg(
        _accuracy(label, "prediction"),
        F.avg(F.pow(error, 2)).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.count_if(positive).alias("scored_rows"),
    )
