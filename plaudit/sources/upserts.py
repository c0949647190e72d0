"""Tables that change in place: keyed merges by bucket and conditional updates by file.

Both rewrite only the part of a table that holds changed rows.  A keyed table is laid out in
folders by the hash of its key, so a merge touches the buckets of the keys it meets.  A
conditional update asks the table which files hold matching rows, where the statistics of the
files rule out most of them, and replaces those files.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaudit.session import cut_lineage
from plaudit.sources.documents import merge_columns, update_where
from plaudit.sources.files import file_system

BUCKET = "key_bucket"
STAGED = "_update-"
REPLACED = "_replaced"


@dataclass(frozen=True)
class KeyedTable:
    """A parquet table in `buckets` folders by the hash of its key.

    Choose as many buckets as tasks should share a full rewrite; the number belongs to the table.
    """

    path: str
    key: str
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def write(self, df: DataFrame) -> None:
        """Replace the table."""
        placed = df.withColumn(BUCKET, self._bucket()).repartition(self.buckets, BUCKET)
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)

    def _stored(self, spark: SparkSession) -> DataFrame:
        # Merges can add columns, which buckets they left alone lack.
        return spark.read.option("mergeSchema", "true").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop(BUCKET)

    def merge(self, updates: DataFrame) -> int:
        """Give matched rows the values of `updates` (one row per key); unmatched updates are dropped.

        Returns how many buckets were rewritten: those that hold a matched key.  A bucket is replaced
        after its new rows are written, so a failed merge leaves the table as it was or
        with some buckets merged, and can be run again.
        """
        spark = updates.sparkSession
        changes = cut_lineage(updates.withColumn(BUCKET, self._bucket()), "updates")
        stored = self._stored(spark)
        named = [row[0] for row in changes.select(BUCKET).distinct().collect()]
        keys = stored.filter(F.col(BUCKET).isin(named)).select(BUCKET, self.key)
        met = keys.join(changes.select(BUCKET, self.key), [BUCKET, self.key], "left_semi")
        touched = [row[0] for row in met.select(BUCKET).distinct().collect()]
        if not touched:
            return 0
        merged = merge_columns(stored.filter(F.col(BUCKET).isin(touched)), changes.drop(BUCKET), self.key)
        (
            merged.repartition(len(touched), BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.path)
        )
        return len(touched)


def _staged(spark: SparkSession, path: str) -> list[str]:
    system, place = file_system(spark, path)
    return [str(s.getPath()) for s in system.listStatus(place) if s.isDirectory() and s.getPath().getName().startswith(STAGED)]


def finish_updates(spark: SparkSession, path: str) -> None:
    """Complete or drop updates of a table that were cut off.

    An update counts once the list of the files it replaces is written: those files go and the new
    ones take their place, as often as this is tried.  Without the list its files are dropped.
    """
    for folder in _staged(spark, path):
        system, place = file_system(spark, folder)
        listed = file_system(spark, f"{folder}/{REPLACED}/_SUCCESS")[1]
        if system.exists(listed):
            for row in spark.read.text(f"{folder}/{REPLACED}").toLocalIterator():
                system.delete(file_system(spark, row[0])[1], False)
            for status in system.listStatus(place):
                name = status.getPath().getName()
                if status.isFile() and not name.startswith(("_", ".")):
                    system.rename(status.getPath(), file_system(spark, f"{path}/{name}")[1])
        system.delete(place, True)


def update_in_place(spark: SparkSession, path: str, condition: Column, changes: Mapping[str, Column]) -> int:
    """Set columns on the rows of a parquet table that meet the condition; returns how many files were rewritten.

    Rows of a file that stay as they are are copied with it.  Files without a matching row are not
    touched, and row groups whose statistics exclude the condition are not even read.  The
    table lies in one folder without partitions; one update runs at a time, and readers wait for its end.
    """
    finish_updates(spark, path)
    table = spark.read.parquet(path)
    hits = table.filter(condition).select(F.col("_metadata.file_path").alias("file")).distinct()
    # One path per file to rewrite.
    files = [unquote(row["file"]) for row in hits.collect()]
    if not files:
        return 0
    folder = f"{path}/{STAGED}{uuid.uuid4().hex}"
    rows = spark.read.schema(table.schema).parquet(*files)
    update_where(rows, condition, changes).write.parquet(folder)
    spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.text(f"{folder}/{REPLACED}")
    finish_updates(spark, path)
    return len(files)
