"""Session builder and shared scratch space."""

from __future__ import annotations

import contextlib
import contextvars
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  ANSI stays on (Spark 4 default); operators
# use try_cast / try_divide where the reference relied on NULL-on-error.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    app_name: str = "tripmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session.  ``master`` only for local runs; on a
    cluster the launcher decides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset in local mode (tests,
    laptops) create a fresh one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
    else:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
    return base


#: Rows of a shuffle that a task is dealt, about: what it sorts then fits its memory.
TASK_ROWS = 400_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for a shuffle of ``rows`` rows: as many as can run at once, and more where a
    task's share would have to be sorted on disk.  Adaptive execution would merge
    partitions by their compressed size, beyond what a task sorts in memory."""
    return max(1, spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tripmart/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, where it exists."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """The shuffle files of each action inside go when it ends.  Otherwise they stay until
    the driver collects its garbage, and the disk holds those of all steps of a job."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


_STAGED: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("staged", default=None)


@contextlib.contextmanager
def staging(spark: SparkSession):
    """Tables staged inside are deleted at its end: no frame made from them is read later."""
    paths: list[str] = []
    token = _STAGED.set(paths)
    try:
        yield
    finally:
        _STAGED.reset(token)
        for path in paths:
            remove(spark, path)


def staged(df: DataFrame, name: str, partition_by=()) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and a lost
    executor costs a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (paths := _STAGED.get()) is not None:
        paths.append(path)
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
