"""Exact-size, repeatable selections by hash order, and dense row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plaudit.functions.texts import digest

# Four hexadecimal digits give 65,536 groups of hash values: a bounded table
# however many rows there are, and only one of its groups is ever sorted.
PREFIX = 4
DIGEST, GROUP = "__digest", "__group"


def _with_digest(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    return df.withColumn(DIGEST, digest(*key, seed=seed)).withColumn(
        GROUP, F.substring(DIGEST, 1, PREFIX)
    )


def _cuts(hashed: DataFrame, strata: Sequence[str], quota: Column) -> DataFrame:
    """Per stratum the hash group in which the quota is reached and the rows taken from it."""
    per_stratum = Window.partitionBy(*strata)
    lower = per_stratum.orderBy(GROUP).rowsBetween(Window.unboundedPreceding, -1)
    return (
        hashed.groupBy(*strata, GROUP)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rows", F.sum("n").over(per_stratum))
        .withColumn("before", F.coalesce(F.sum("n").over(lower), F.lit(0)))
        .withColumn("quota", quota)
        .filter((F.col("before") < F.col("quota")) & (F.col("quota") <= F.col("before") + F.col("n")))
        .select(*strata, F.col(GROUP).alias("cut"), (F.col("quota") - F.col("before")).alias("taken"))
    )


def sample_rows(df: DataFrame, key: Sequence[str], n: int | None, seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if fewer): those with the smallest key hashes.

    Repeatable for a unique key.  The rows stay distributed whatever n is.
    """
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    hashed = _with_digest(df, key, seed)
    whole = hashed.withColumn("__all", F.lit(0))
    cut = _cuts(whole, ["__all"], F.lit(n)).first()
    if cut is None:
        return df
    below = hashed.filter(F.col(GROUP) < cut["cut"])
    edge = hashed.filter(F.col(GROUP) == cut["cut"]).orderBy(DIGEST, *key).limit(cut["taken"])
    return below.unionByName(edge).drop(DIGEST, GROUP)


def stratified_split(
    df: DataFrame, stratum: str, key: Sequence[str], fraction: float = 0.8, seed: int = 42
) -> DataFrame:
    """Add `is_train`, true for exactly `floor(fraction * rows)` rows of every stratum.

    A stratum may hold most of the rows: only the one hash group around its cut
    is ranked, the rest is decided row by row.  `stratum` must have few values.
    """
    hashed = _with_digest(df, key, seed)
    cuts = _cuts(hashed, [stratum], F.floor(F.col("rows") * F.lit(fraction))).withColumnRenamed(
        stratum, "__stratum"
    )
    # One row per stratum: small enough for every task.
    placed = hashed.join(
        F.broadcast(cuts), F.col(stratum).eqNullSafe(F.col("__stratum")), "left"
    ).drop("__stratum")
    on_edge = F.coalesce(F.col(GROUP) == F.col("cut"), F.lit(False))
    clear = placed.filter(~on_edge).withColumn(
        "is_train", F.coalesce(F.col(GROUP) < F.col("cut"), F.lit(False))
    )
    order = Window.partitionBy(stratum).orderBy(DIGEST, *key)
    edge = placed.filter(on_edge).withColumn(
        "is_train", F.row_number().over(order) <= F.col("taken")
    )
    return clear.unionByName(edge).drop(DIGEST, GROUP, "cut", "taken")


def dense_index(df: DataFrame, key: Sequence[str], seed: int = 0, name: str = "index") -> DataFrame:
    """Number the rows 0, 1, 2, ... in hash order of a unique key, group by group."""
    hashed = _with_digest(df, key, seed)
    lower = Window.orderBy(GROUP).rowsBetween(Window.unboundedPreceding, -1)
    # At most 16^PREFIX rows: bounded, so one task may accumulate and all may hold it.
    offsets = (
        hashed.groupBy(GROUP)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(GROUP, F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("__offset"))
    )
    inside = Window.partitionBy(GROUP).orderBy(DIGEST, *key)
    return (
        hashed.withColumn("__row", F.row_number().over(inside))
        .join(F.broadcast(offsets), GROUP)
        .withColumn(name, F.col("__offset") + F.col("__row") - 1)
        .drop(DIGEST, GROUP, "__offset", "__row")
    )
