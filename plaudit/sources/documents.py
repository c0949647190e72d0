"""Loading, refreshing and repairing document tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plaudit.functions.texts import split_list, trimmed_items
from plaudit.operators.cleaning import clean_users
from plaudit.sources.files import scan_json_lines, write_table
from plaudit.sources.schemas import KEYS, RAW_USER


def without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating-point column."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(field.name), F.col(field.name)).alias(field.name)
            if isinstance(field.dataType, floats)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def friends_as_list(df: DataFrame) -> DataFrame:
    """Turn a `friends` string into a trimmed list; lists pass unchanged."""
    if "friends" not in df.columns or not isinstance(df.schema["friends"].dataType, T.StringType):
        return df
    text = F.col("friends")
    listed = F.when(text.isin("None", ""), F.array().cast("array<string>")).otherwise(
        trimmed_items(split_list(text, ","))
    )
    return df.withColumn("friends", listed)


def load_documents(df: DataFrame, collection: str) -> DataFrame:
    """The rows a collection accepts: cleaned values and one row per key, renamed `_id`.

    Tips have no key and keep all their rows.
    """
    loaded = friends_as_list(without_nan(df))
    key = KEYS.get(collection)
    if key is None:
        return loaded
    # Of documents that share a key the one with the smallest text stays, so a repeated task agrees.
    whole = F.struct(*loaded.columns)
    first = loaded.groupBy(key).agg(F.min_by(whole, F.to_json(whole)).alias("first"))
    return first.select("first.*").withColumnRenamed(key, "_id")


def reload_users(spark: SparkSession, raw_path: str, target: str) -> DataFrame:
    """Full refresh of the users table from its raw file."""
    write_table(clean_users(scan_json_lines(spark, raw_path, RAW_USER)), target)
    return spark.read.parquet(target)


def merge_columns(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Keyed merge: matched rows take the new values, unmatched updates are dropped.

    Rows without an update keep theirs.  `updates` holds one row per key.
    """
    fresh = [name for name in updates.columns if name != key]
    renamed = updates.select(
        key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in fresh]
    )
    joined = target.join(renamed, key, "left")
    for name in fresh:
        kept = F.col(name) if name in target.columns else F.lit(None)
        joined = joined.withColumn(
            name, F.when(F.col("__hit"), F.col(f"__new_{name}")).otherwise(kept)
        )
    return joined.drop("__hit", *[f"__new_{c}" for c in fresh])


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows that meet the condition (null counts as not met)."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[
            F.when(hit, changes[name]).otherwise(F.col(name)).alias(name)
            if name in changes
            else F.col(name)
            for name in df.columns
        ]
    )


def add_missing(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Set a column where it does not exist: absent altogether, or null in a row."""
    if column not in df.columns:
        return df.withColumn(column, value)
    return df.withColumn(column, F.coalesce(F.col(column), value))
