"""Raw files to cleaned tables in bounded batches, with Structured Streaming.

The same cleaning functions run on every micro-batch.  The checkpoint remembers
which files are done, so a stopped run continues where it was and new files are
picked up by the next run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from plaudit.operators.cleaning import clean_reviews, clean_tips, clean_users
from plaudit.sources.schemas import RAW

CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "user": clean_users,
    "review": clean_reviews,
    "tip": clean_tips,
}


def ingest_folder(
    spark: SparkSession,
    entity: str,
    source: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Clean all JSON-lines files of a folder that earlier runs have not seen."""
    raw = (
        spark.readStream.schema(RAW[entity])
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source)
    )
    return (
        CLEANERS[entity](raw)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
