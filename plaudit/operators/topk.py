"""Top-k selections with complete tie-breaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _order(column: str, descending: bool) -> Column:
    # Missing sorts below every number: last when descending, first when ascending.
    return F.desc_nulls_last(column) if descending else F.asc_nulls_first(column)


def top_k(df: DataFrame, by: str, keys: Sequence[str], k: int, descending: bool = True) -> DataFrame:
    """The k first rows; each task keeps only its own k before anything is merged."""
    return df.orderBy(_order(by, descending), *[F.asc(key) for key in keys]).limit(k)


def both_ends(df: DataFrame, by: str, keys: Sequence[str], k: int) -> DataFrame:
    """The k highest rows and the k lowest rows, the lowest one first.

    Adds `side` (`best` or `worst`) and `place` (1..k within the side).
    """
    best = top_k(df, by, keys, k).withColumn("side", F.lit("best"))
    worst = (
        df.orderBy(_order(by, False), *[F.desc(key) for key in keys])
        .limit(k)
        .withColumn("side", F.lit("worst"))
    )

    def placed(part: DataFrame, descending: bool) -> DataFrame:
        order = [_order(by, descending)] + [F.asc(c) if descending else F.desc(c) for c in keys]
        return part.withColumn(
            "place", F.row_number().over(Window.partitionBy("side").orderBy(*order))
        )

    return placed(best, True).unionByName(placed(worst, False))


def top_per_group(
    df: DataFrame,
    groups: Sequence[str],
    by: str,
    keys: Sequence[str],
    k: int,
    descending: bool = True,
    place: str = "place",
) -> DataFrame:
    """The k first rows of every group.

    The rank filter reaches below the shuffle, so a task forwards at most k rows
    per group and a dominant group stays small.
    """
    order = Window.partitionBy(*groups).orderBy(
        _order(by, descending), *[F.asc(key) for key in keys]
    )
    return df.withColumn(place, F.row_number().over(order)).filter(F.col(place) <= k)


def most_frequent(df: DataFrame, groups: Sequence[str], item: str) -> DataFrame:
    """Mode of `item` per group with its count and the group's size.

    Ties go to the smallest item.  Counting happens before the comparison, so a
    large group is reduced to its distinct items first.
    """
    counts = df.groupBy(*groups, item).agg(F.count(F.lit(1)).alias("n"))
    return mode_of_counts(counts, groups, item)


def mode_of_counts(
    counts: DataFrame, groups: Sequence[str], item: str, sums: Sequence[str] = ()
) -> DataFrame:
    """Mode per group of a frequency table with the columns `item` and `n`.

    Columns named in `sums` are added up per group alongside.
    """
    leader = F.min(F.struct((-F.col("n")).alias("rank"), F.col(item)))
    return (
        counts.groupBy(*groups)
        .agg(
            F.sum("n").alias("n_total"), leader.alias("leader"), *[F.sum(c).alias(c) for c in sums]
        )
        .select(
            *groups,
            F.col(f"leader.{item}").alias(item),
            (-F.col("leader.rank")).alias("n_item"),
            "n_total",
            *sums,
        )
    )
