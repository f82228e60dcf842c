"""Writers (K1-K4, K7, K8) and physical layout (M5).

Writers return the number of rows written, measured by an ``Observation`` in
the same job as the write (no second pass over the data).  Partitioned
overwrites default to *dynamic* mode: only the partitions present in the
output are replaced, so a re-run or a late-data recompute is idempotent.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripmart.operators.dedup import texts_apart, texts_in_one
from tripmart.session import remove, shuffles_freed  # noqa: F401

MONTH = "trip_month"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: A write of at most so many rows a slot goes through a plain hash: no partition of
#: it can be too large for a task.
PLAIN_ROWS = 1_000_000


def slots(spark) -> int:
    """Tasks that can run at once."""
    return max(1, spark.sparkContext.defaultParallelism)


def writing_tasks(spark, rows: int | None) -> int | None:
    """Tasks for a partitioned write of ``rows`` rows: every slot where no partition can
    be large, NULL (a rebalance, which splits large partitions) where one might be."""
    return slots(spark) if rows is not None and rows <= PLAIN_ROWS * slots(spark) else None


def layout(df: DataFrame, partition_cols=("trip_date",), sort_cols=(), tasks: int | None = None) -> DataFrame:
    """M5: cluster rows by the partition columns and sort inside each file by the sort
    keys.

    By default through REBALANCE: adaptive execution splits a partition that holds a
    hot day, so no task writes a third of the data, and merges small ones.  With
    ``tasks`` a plain hash over that many tasks, which are not merged: for marts and
    other small outputs, where the number of files is the cost."""
    if isinstance(partition_cols, str):
        partition_cols = (partition_cols,)
    partition_cols = tuple(partition_cols or ())
    if partition_cols:
        df = df.repartition(tasks, *partition_cols) if tasks else df.hint("rebalance", *partition_cols)
    keys = [*partition_cols, *[c for c in sort_cols if c not in partition_cols]]
    return df.sortWithinPartitions(*keys) if keys else df


def by_month(df: DataFrame, date_col: str = "trip_date") -> DataFrame:
    """The month of ``date_col`` as partition column ``trip_month`` (NULL without a date)."""
    return df.withColumn(MONTH, F.date_format(date_col, "yyyy-MM"))


def write_counted(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by=("trip_date",),
    overwrite_mode: str = "dynamic",
    fmt: str = "parquet",
    options: dict | None = None,
    cluster: bool = True,
    sort_by=(),
    tasks: int | None = None,
) -> int:
    """K1/K2/K3/K8: write and return the row count from the same job.
    Partitioned writes are clustered by the partition columns first
    (``cluster``), so each partition gets few, large files."""
    obs = Observation(f"write-{abs(hash(path)) % 10**8}")
    if partition_by and cluster:
        df = layout(df, partition_by, sort_by, tasks)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "overwrite" and partition_by:
        writer = writer.option("partitionOverwriteMode", overwrite_mode)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    with shuffles_freed(df.sparkSession):
        writer.save(path)
    return observed_rows(obs)


def observed_rows(obs: Observation) -> int:
    """The observed count; 0 where the optimizer proved the input empty and
    dropped the observation from the plan."""
    try:
        return int(obs.get.get("rows", 0))
    except AssertionError:
        return 0


def exists(spark, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def file_count(spark, path: str, suffix: str = ".parquet") -> int:
    """Files with rows or without that lie directly in a folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(s.getPath().getName().endswith(suffix) for s in fs.listStatus(folder)) if fs.exists(folder) else 0


def partition_values(spark, path: str, partition_col: str) -> set[str]:
    """Values of the first-level partition folders below ``path``."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return set()
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return {n.split("=", 1)[1] for n in names if n.startswith(f"{partition_col}=")}


def replace_partitions(df: DataFrame, path: str, values, partition_col: str = "trip_date", sort_by=(), tasks: int | None = None, cluster: bool = True) -> int:
    """K2 for a list of touched partitions: ``df`` holds all that is left of them.
    Those it has rows for are overwritten, the others are deleted.  Without ``cluster``
    the rows are written where they are."""
    rows = write_counted(df, path, partition_by=(partition_col,), sort_by=sort_by, tasks=tasks, cluster=cluster)
    spark = df.sparkSession
    name = lambda v: NULL_PARTITION if v is None else str(v)
    left = {name(r[0]) for r in df.select(partition_col).distinct().collect()}  # at most the touched partitions
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for value in {name(v) for v in values} - left:
        fs.delete(jvm.org.apache.hadoop.fs.Path(folder, f"{partition_col}={value}"), True)
    return rows


def append_partitioned(df: DataFrame, path: str, partition_col: str, cluster: bool = True) -> int:
    """K1.  Without ``cluster`` the rows are written by the tasks that have them, a file a
    task and partition, and not moved once more."""
    return write_counted(df, path, mode="append", partition_by=(partition_col,), cluster=cluster)


def overwrite_partitioned(
    df: DataFrame, path: str, partition_col: str = "trip_date", dynamic: bool = True, sort_by=(), tasks: int | None = None
) -> int:
    """K2: dynamic (replace touched partitions) or static (full refresh)."""
    return write_counted(
        df,
        path,
        mode="overwrite",
        partition_by=(partition_col,),
        overwrite_mode="dynamic" if dynamic else "static",
        sort_by=sort_by,
        tasks=tasks,
    )


def overwrite(df: DataFrame, path: str) -> int:
    """K3."""
    return write_counted(df, path, mode="overwrite", partition_by=())


def write_if_rows(df: DataFrame, path: str, partition_col: str | None = None, mode: str = "append") -> int:
    """K4: skip the write when there is nothing to write.  The frame is staged, so
    its plan runs once for the probe and the write."""
    staged = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if staged.isEmpty():
            return 0
        return write_counted(staged, path, mode=mode, partition_by=(partition_col,) if partition_col else ())
    finally:
        staged.unpersist()


def write_landing_csv(df: DataFrame, path: str, time_col: str = "departure_time", compression: str | None = None) -> int:
    """K7: raw rows as header CSV under ``year=/month=`` of ``time_col``, with
    ``compression`` (``gzip``) where plain text would be too large.
    Rows without a parsable time keep NULL year/month (Spark's default
    partition) instead of being lost.

    Rows are moved as they are typed, their texts in one column, and become text where
    they are written: as text they take about twice the space."""
    ts = F.col(time_col).try_cast("timestamp_ntz")
    timed = df.withColumns({"year": F.year(ts), "month": F.month(ts)})
    out = texts_apart(layout(texts_in_one(timed), ("year", "month")), timed)
    out = out.select(*[F.col(c).cast("string") if c not in ("year", "month") else F.col(c) for c in out.columns])
    options = {"header": "true"} | ({"compression": compression} if compression else {})
    return write_counted(out, path, mode="overwrite", partition_by=("year", "month"), fmt="csv", options=options, cluster=False)
