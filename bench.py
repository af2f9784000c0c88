"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the input tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names (default: the headline list)
BENCH_SHARED  folder for derived tables and checkpoints (default: a temporary one, removed at the end)
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabloom.plans.queries import QUERIES  # noqa: E402
from tabloom.session import build_session  # noqa: E402
from tabloom.sources import derived  # noqa: E402

HEADLINE = (
    "missing_rate_categorical",
    "missing_rate_continuous",
    "value_counts",
    "most_common_value",
    "class_balance",
    "impute_mode",
    "impute_mean",
    "undersample_majority",
    "shuffle_rows",
    "auc_roc",
    "prepare_signal",
    "prepare_claims",
    "forest_report",
    "boosted_report",
    "claims_linear_report",
    "claims_two_stage_report",
    "best_params",
    "gbt_cross_validate",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    shared = os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "tabloom-bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": shared,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    # The stand-in tables are derived from lineitem once, like any ingest.
    for table in (derived.signal, derived.signal_text, derived.claims):
        timed(f"derive_{table.__name__}", lambda t=table: t(spark, folder))
    for name in names:
        timed(name, lambda q=QUERIES[name]: q(spark, folder).write.format("noop").mode("overwrite").save())
    derived.release(spark)
    spark.stop()
    if not os.environ.get("BENCH_SHARED"):
        shutil.rmtree(shared)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
