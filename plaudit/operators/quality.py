"""Counts, field checks and key checks over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: name and number of rows."""
    parts = [
        table.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def field_checks(name: str, table: DataFrame, expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """Presence, type and number of nulls of every expected field, in one pass."""
    types = dict(table.dtypes)
    entries = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(field).alias("field"),
            F.lit(field in types).alias("is_present"),
            F.lit(types.get(field)).cast("string").alias("actual_type"),
            F.lit(types.get(field) in kinds).alias("type_ok"),
            (
                F.count_if(F.col(field).isNull()) if field in types else F.count(F.lit(1))
            ).alias("n_missing"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        for field, kinds in expected.items()
    ]
    return table.agg(F.array(*entries).alias("checks")).select(F.inline("checks"))


def check_tables(
    tables: Mapping[str, DataFrame], expected: Mapping[str, Mapping[str, Sequence[str]]]
) -> DataFrame:
    """Field checks of several tables."""
    parts = []
    for name, fields in expected.items():
        if name in tables:
            parts.append(field_checks(name, tables[name], fields))
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return table.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def key_violations(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table the number of duplicated keys and of rows beyond the first of each."""
    parts = [
        duplicate_keys(table, key)
        .agg(
            F.count(F.lit(1)).alias("n_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_extra_rows"),
        )
        .select(F.lit(name).alias("name"), "n_keys", "n_extra_rows")
        for name, (table, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
