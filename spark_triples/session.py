"""Shared scratch space and the session settings results depend on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SPLITS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
# Compressed bytes of a table that one task should get where it holds its rows or sorts them: some
# hundred thousand rows.
TASK_BYTES = 2 << 20
# What Python workers get at once where rows are texts of megabytes.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone, so that timestamps read the same on every machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: the cluster's checkpoint directory.

    Only a local session may fall back to a temporary folder; on a cluster such a
    folder would exist on one machine only, so a missing setting is an error there.
    """
    base = (
        spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    )
    master = spark.sparkContext.master
    if base:
        return base.rstrip("/")
    if not master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark_triples-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_job: ContextVar[str | None] = ContextVar("job", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder, or in that of the running job."""
    return f"{_job.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Put what a job stages in one folder, and remove it when the job is over. For jobs
    that write their result; a returned DataFrame still needs what was staged for it."""
    folder = scratch_path(spark, "job")
    token = _job.set(folder)
    try:
        yield
    finally:
        _job.reset(token)
        delete(spark, folder)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, int]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def small_splits(spark: SparkSession, most: int = TASK_BYTES) -> AbstractContextManager[None]:
    """Let the scans of the jobs run inside have tasks of at most ``most`` bytes, or of one file or row
    group. By default Spark packs 128 MB into a task, which are tens of millions of the rows of
    a table: too many for a hash table of them. Only sizes of tasks depend on it."""
    return _settings(spark, dict(zip(SPLITS, (most, most // 4), strict=True)))


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> AbstractContextManager[None]:
    """Let the jobs run inside hand rows to Python workers in batches of at most ``most`` bytes and a row.
    By default a batch has up to 64 MB, which is held several times: by the JVM, outside its heap, and
    by the worker. Only sizes of batches depend on it, not what a group of a grouped function is."""
    return _settings(spark, {BATCH: most})


def stage(df: DataFrame, name: str, group_bytes: int | None = None, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at files that outlive executors, and freezes anything that
    may differ between two evaluations (range bounds, partition ids). ``group_bytes``: row groups
    smaller than Parquet's own, for a large table that is read in small splits. ``group_rows``: row
    groups of few rows, where these are texts of megabytes. Bytes alone do not bound such groups: they are
    looked at after a hundred rows, and are those of compressed pages. A reader holds a group's rows.
    """
    path = scratch_path(df.sparkSession, name)
    options = {"parquet.block.size": group_bytes} if group_bytes else {}
    if group_rows:
        options["parquet.block.row.count.limit"] = group_rows
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Entry(NamedTuple):
    path: str
    is_dir: bool
    size: int
    modified: int


def glob(spark: SparkSession, pattern: str) -> list[Entry]:
    """Files and directories a path pattern matches, on whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(path) or []
    return [
        Entry(s.getPath().toString(), s.isDirectory(), s.getLen(), s.getModificationTime())
        for s in found
    ]


def file_system(spark: SparkSession, name: str):
    """The file system of a path, and the path as it takes it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete(spark: SparkSession, name: str) -> None:
    """Remove a file or a folder with all that is in it."""
    fs, path = file_system(spark, name)
    fs.delete(path, True)


def make_dir(spark: SparkSession, path: str) -> None:
    """Create a folder, unless it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
