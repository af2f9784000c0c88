"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Wide tables generate methods the JVM will not compile (over 8000 bytes of
# code); beyond the limit Spark splits them, which is 2x faster here.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit", "8000"


def build_session(app_name: str = "tabloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans rely on; `master` is left to spark-submit by default."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        METHOD_LIMIT[0]: METHOD_LIMIT[1],
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compile_wide_stages(spark: SparkSession) -> None:
    """The method limit of `build_session` in a session that was built elsewhere and does not set it."""
    key, limit = METHOD_LIMIT
    if spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, limit)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tabloom-"))
    return context.getCheckpointDir()


_made: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; `clear_scratch` knows it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> int:
    """How many paths `fresh_path` has given this application."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def delete_path(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete what this application wrote to paths of `fresh_path`, from number `since` on; returns how many paths.

    For the end of a job, when its results are written elsewhere: DataFrames that read such tables can't be read any more.
    """
    made = _made.get(spark.sparkContext.applicationId, [])
    paths = made[since:]
    del made[since:]
    for name in paths:
        delete_path(spark, name)
    return len(paths)
