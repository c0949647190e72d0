"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Casts between dates, timestamps and texts need one time zone everywhere.
RUNTIME_OPTIONS = {"spark.sql.session.timeZone": "UTC"}


def tune(spark: SparkSession) -> SparkSession:
    """Set the options that results depend on where the application has not chosen them itself."""
    chosen = spark.sparkContext.getConf()
    for key, value in RUNTIME_OPTIONS.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    A local-mode session without the setting gets a temporary folder.  On a
    cluster a machine-local folder would not survive the loss of its machine, so
    there the setting is required.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="plaudit-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


# Paths written by `cut_lineage`, one list per open `temporary_tables`.
_written: list[list[str]] = []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table on any Hadoop file system; nothing happens if it is gone."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete at the end every table that `cut_lineage` wrote inside the block.

    What the block computes must have been written by then: a plan that still reads one of these tables fails.
    """
    _written.append([])
    try:
        yield
    finally:
        for path in _written.pop():
            remove_path(spark, path)


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder once and return a scan of what was written.

    Later plans start from columnar files with known sizes instead of repeating
    the work, and a lost executor costs only a re-read.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    if _written:
        _written[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
