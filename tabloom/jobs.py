"""The whole workflows on CSV files, for spark-submit.

    spark-submit run_job.py fit-forest --input /data/signal.csv --output /data/forest
    spark-submit run_job.py claims-two-stage --input /data/claims.csv --output /data/claims

Each result is written whole as Parquet below the output folder; what is printed is a
preview. Master, memory and the shared folder (`spark.checkpoint.dir`) come from the
submit command or the cluster's defaults.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.config import BOOSTED_GRID, CLAIMS, FOREST_GRID, SIGNAL_COLUMNS, SIGNAL_LABEL
from tabloom.functions.hashing import with_row_key
from tabloom.operators.columns import cast_double
from tabloom.operators.impute import fill_mode
from tabloom.operators.models import boosted, forest
from tabloom.operators.profile import class_balance, value_counts
from tabloom.plans import claims, signal
from tabloom.session import build_session, clear_scratch, fresh_path, scratch_paths
from tabloom.sources.csv import scan_csv_header, scan_csv_positional

ESTIMATORS = {"forest": (forest, FOREST_GRID), "boosted": (boosted, BOOSTED_GRID)}


PREVIEW_ROWS = 20


def as_parquet(raw: DataFrame, name: str) -> DataFrame:
    """The rows as Parquet in the shared folder, so that the passes over them parse no text again."""
    path = fresh_path(raw.sparkSession, name)
    raw.write.parquet(path)
    return raw.sparkSession.read.parquet(path)


def load_signal(spark: SparkSession, path: str) -> DataFrame:
    """Typed columns and a row key made of the values. Labels other than 0 and 1 fail the fit."""
    raw = with_row_key(scan_csv_positional(spark, path))
    return as_parquet(cast_double(raw, SIGNAL_COLUMNS), "signal")


def fit_job(spark: SparkSession, path: str, kind: str) -> dict[str, DataFrame]:
    raw = load_signal(spark, path)
    fitted = signal.fit_classifier(signal.prepare_signal(raw), ESTIMATORS[kind][0]())
    return {"report": fitted.report(), "importances": fitted.importances()}


def tune_job(spark: SparkSession, path: str, kind: str) -> dict[str, DataFrame]:
    raw = load_signal(spark, path)
    estimator, grid = ESTIMATORS[kind]
    tuned, fitted = signal.tune_classifier(signal.prepare_signal(raw), estimator(), grid)
    return {
        "class balance": class_balance(raw, SIGNAL_LABEL),
        "grid": tuned.metrics_table(spark),
        "best": tuned.best_params(spark),
        "report": fitted.report(),
    }


def row_counts(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(rows, complete_rows, dropped_rows): how many rows had no use after the casts."""
    complete = clean.agg(F.count("*").alias("n")).scalar()
    return raw.agg(F.count("*").alias("rows")).select(
        "rows", complete.alias("complete_rows"), (F.col("rows") - complete).alias("dropped_rows")
    )


def claims_job(spark: SparkSession, path: str, two_stage: bool, train_only: bool) -> dict[str, DataFrame]:
    raw = as_parquet(scan_csv_header(spark, path, names=None), "claims")
    rows = claims.balance_and_split(raw, train_only=train_only)
    regress = claims.regress_claims_two_stage if two_stage else claims.regress_claims
    return {
        "missing rates": rows.preparation.rates_table(spark),
        "rows": row_counts(raw, rows.preparation.clean(raw)),
        "values": value_counts(raw, CLAIMS.categorical),
        "values imputed": value_counts(
            fill_mode(raw, rows.preparation.modes), list(rows.preparation.modes)
        ),
        "report": regress(rows).report(),
    }


JOBS = {
    "fit-forest": lambda spark, args: fit_job(spark, args.input, "forest"),
    "fit-boosted": lambda spark, args: fit_job(spark, args.input, "boosted"),
    "tune-forest": lambda spark, args: tune_job(spark, args.input, "forest"),
    "tune-boosted": lambda spark, args: tune_job(spark, args.input, "boosted"),
    "claims-linear": lambda spark, args: claims_job(spark, args.input, False, args.train_only),
    "claims-two-stage": lambda spark, args: claims_job(spark, args.input, True, args.train_only),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tabloom.jobs", description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--input", required=True, help="CSV file or folder")
    parser.add_argument("--output", required=True, help="folder for the result tables")
    parser.add_argument(
        "--train-only", action="store_true", help="claims: learn and balance on the training rows alone"
    )
    args = parser.parse_args(argv)
    spark = build_session(f"tabloom {args.job}")
    before = scratch_paths(spark)
    try:
        for title, table in JOBS[args.job](spark, args).items():
            path = f"{args.output.rstrip('/')}/{title.replace(' ', '_')}"
            table.write.mode("overwrite").parquet(path)
            written = spark.read.parquet(path)
            print(f"{title}: {written.count()} rows in {path}; the first {PREVIEW_ROWS}:")
            written.show(PREVIEW_ROWS, truncate=False)
    finally:
        clear_scratch(spark, before)


if __name__ == "__main__":
    main()
