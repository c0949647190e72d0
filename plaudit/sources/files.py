"""Scans and sinks: JSON lines, parquet directories, head extracts, result sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def scan_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Strict scan: a malformed line fails the read instead of turning into nulls."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_json_lines(df: DataFrame, path: str, rows_per_file: int = 20_000) -> None:
    """Compressed JSON lines; a compressed file has one reader, so none holds more than `rows_per_file` lines."""
    df.write.option("maxRecordsPerFile", rows_per_file).json(path, compression="gzip")


def scan_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet directory, restricted to the wanted columns at the scan."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a parquet directory; one part per task.  Texts are most of it, hence the denser codec."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression="zstd")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path object of a path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def list_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Files directly inside a folder of any Hadoop file system."""
    system, path = file_system(spark, folder)
    found = [status.getPath() for status in system.listStatus(path) if status.isFile()]
    return sorted(str(item) for item in found if item.getName().endswith(suffix))


def head_of_file(spark: SparkSession, path: str, lines: int) -> DataFrame:
    """`value`: the first lines of a text file, in order.

    Blocks are read one after the other until there are enough lines, usually the leading one only.  Should they
    not come back as the leading block, the whole file is put in order by block and by place within it.
    """
    text = spark.read.text(path).select(
        "value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")
    )
    # A fixed number of lines.
    first = text.take(lines)
    if len(first) == lines and all(row["block"] == 0 for row in first):
        return spark.createDataFrame([(row["value"],) for row in first], "value string").coalesce(1)
    return text.orderBy("block", "at").limit(lines).orderBy("block", "at").select("value").coalesce(1)


def extract_heads(spark: SparkSession, source: str, target: str, lines: int = 5000) -> list[str]:
    """Copy the first lines of every JSON file of a folder to `<target>/<file>_head.json`."""
    written = []
    for path in list_files(spark, source, ".json"):
        name = path.rsplit("/", 1)[-1]
        out = f"{target}/{name}_head.json"
        head_of_file(spark, path, lines).write.mode("overwrite").text(out)
        written.append(out)
    return written


def write_results(results: Mapping[str, DataFrame], folder: str, form: str = "json") -> None:
    """Write named result sets, one directory per name."""
    for name, result in results.items():
        result.write.mode("overwrite").format(form).save(f"{folder}/{name}")


def append_result(result: DataFrame, folder: str, name: str, title: str) -> None:
    """Put one titled result set into a common folder, row by row as JSON text.

    A rerun replaces the rows of the same name and leaves the others alone.
    """
    rows = result.select(
        F.lit(name).alias("query"),
        F.lit(title).alias("title"),
        F.to_json(F.struct(*result.columns)).alias("row"),
    )
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query").json(folder)


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """Rows appended with `append_result`."""
    schema = T.StructType().add("title", "string").add("row", "string").add("query", "string")
    return spark.read.schema(schema).json(folder)
