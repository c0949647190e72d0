"""Exact order statistics without sorting everything in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from plaudit.session import cut_lineage

# Distinct values that one task orders.
RANGE_VALUES = 1_000_000


def value_positions(
    df: DataFrame, column: str, weight: str | None = None, range_values: int = RANGE_VALUES
) -> DataFrame:
    """Every distinct non-null value with `n`, its frequency, and `before`, the rows below it.

    A row counts once, or as often as its `weight` says.  Equal values are counted together
    first, so a dominant value costs one row.  The distinct values, of any type that can be
    ordered, are cut into ranges of about `range_values`; each range is accumulated by itself
    and shifted by the rows of all lower ranges.
    """
    counts = cut_lineage(
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n")),
        "values",
    )
    ranges = max(1, math.ceil(counts.count() / range_values))
    # Written, because the borders of the ranges come from a sample and must not change later.
    ranged = cut_lineage(
        counts.repartitionByRange(ranges, "value").withColumn("range", F.spark_partition_id()), "ranges"
    )
    # One row per range.
    lower = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("range")
        .agg(F.sum("n").alias("rows"))
        .select("range", F.coalesce(F.sum("rows").over(lower), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(offsets, "range").select(
        "value",
        "n",
        (F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"),
    )


def percentiles(df: DataFrame, column: str, wanted: Mapping[str, float], **limits) -> DataFrame:
    """One row with a linearly interpolated exact percentile per entry of `wanted` (name to probability).

    Without values every percentile is null.
    """
    positions = value_positions(df, column, **limits)
    rows = positions.agg(F.sum("n")).first()[0] or 0

    def at(index: int):
        here = (F.col("before") <= index) & (F.col("before") + F.col("n") > index)
        return F.max(F.when(here, F.col("value").cast("double")))

    found = []
    for name, probability in wanted.items():
        exact = probability * max(rows - 1, 0)
        low = int(exact)
        below, above = at(low), at(max(min(low + 1, rows - 1), 0))
        found.append((below + (above - below) * (exact - low)).alias(name))
    return positions.agg(*found)


def exact_percentiles(
    df: DataFrame, column: str, probabilities: Sequence[float], **limits
) -> list[float | None]:
    """`percentiles` as numbers, for use as thresholds."""
    names = {f"p{i}": probability for i, probability in enumerate(probabilities)}
    return list(percentiles(df, column, names, **limits).first())


def average_ranks(df: DataFrame, column: str, weight: str | None = None, **limits) -> DataFrame:
    """`value` and `rank` (1-based, ties share their mean rank) per distinct value."""
    return value_positions(df, column, weight, **limits).select(
        "value", (F.col("before") + (F.col("n") + 1) / 2).alias("rank")
    )


def spearman(df: DataFrame, left: str, right: str, **limits) -> DataFrame:
    """Rank correlation of two columns over the rows in which both are present.

    Works on distinct value pairs weighted by frequency; ranks come from the
    distinct values of each side.
    """
    pairs = cut_lineage(
        df.filter(F.col(left).isNotNull() & F.col(right).isNotNull())
        .groupBy(F.col(left).alias("a"), F.col(right).alias("b"))
        .agg(F.count(F.lit(1)).alias("w")),
        "pairs",
    )
    rank_a = average_ranks(pairs, "a", "w", **limits).toDF("a", "x")
    rank_b = average_ranks(pairs, "b", "w", **limits).toDF("b", "y")
    ranked = pairs.join(rank_a, "a").join(rank_b, "b")
    n, x, y = F.sum("w"), F.sum(F.col("w") * F.col("x")), F.sum(F.col("w") * F.col("y"))
    xx = F.sum(F.col("w") * F.col("x") * F.col("x"))
    yy = F.sum(F.col("w") * F.col("y") * F.col("y"))
    xy = F.sum(F.col("w") * F.col("x") * F.col("y"))
    moments = ranked.agg(
        n.alias("n"), x.alias("x"), y.alias("y"), xx.alias("xx"), yy.alias("yy"), xy.alias("xy")
    )
    spread = F.sqrt(
        (F.col("xx") - F.col("x") * F.col("x") / F.col("n"))
        * (F.col("yy") - F.col("y") * F.col("y") / F.col("n"))
    )
    return moments.select(
        F.try_divide(F.col("xy") - F.col("x") * F.col("y") / F.col("n"), spread).alias("spearman")
    )


def ranked_areas(df: DataFrame, score: str, label: str, **limits) -> DataFrame:
    """Exact areas under the ROC and the precision-recall curve: `n_positive`, `n_negative`, `auc_roc`, `auc_pr`.

    `label` is 1 or 0; rows without score or label are left out.  Equal scores are one point of the
    curves, so their order does not matter.  Points are joined by straight lines; the precision-recall
    curve starts at recall 0 with the precision of its first point.  Rank sums over the
    distinct scores give both, without sorting in one task.  An area is null without rows of both labels.
    """
    positive = F.col(label) == 1
    counts = cut_lineage(
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(positive).alias("positive"), F.count_if(~positive).alias("negative")),
        "scores",
    )
    right = value_positions(counts, "score", "positive", **limits).toDF("value", "positive", "positive_below")
    wrong = value_positions(counts, "score", "negative", **limits).toDF("value", "negative", "negative_below")
    totals = counts.agg(F.coalesce(F.sum("positive"), F.lit(0)), F.coalesce(F.sum("negative"), F.lit(0))).first()
    p, n = (F.lit(float(t)) for t in totals)
    hits, alarms = p - F.col("positive_below"), n - F.col("negative_below")
    hits_before, alarms_before = hits - F.col("positive"), alarms - F.col("negative")
    precision = hits / (hits + alarms)
    before = F.coalesce(F.try_divide(hits_before, hits_before + alarms_before), precision)
    roc = F.sum(F.col("positive") * (F.col("negative_below") + F.col("negative") / 2))
    pr = F.sum(F.col("positive") * (precision + before) / 2)
    return right.join(wrong, "value").agg(roc.alias("roc"), pr.alias("pr")).select(
        F.lit(totals[0]).cast("long").alias("n_positive"),
        F.lit(totals[1]).cast("long").alias("n_negative"),
        F.try_divide(F.col("roc"), p * n).alias("auc_roc"),
        F.when(n > 0, F.try_divide(F.col("pr"), p)).alias("auc_pr"),
    )
