"""Rounding, guarded division and binning with the semantics stated in the name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round half to even, the rule of the document analytics."""
    return F.bround(value, digits)


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero, the rule of the graph analytics."""
    return F.round(value, digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields null, not an error, for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def total(value: Column) -> Column:
    """Sum in which an all-null group counts as zero."""
    return F.coalesce(F.sum(value), F.lit(0))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def average_where(value: Column, condition: Column) -> Column:
    """Mean of the rows that meet the condition; null when none does."""
    return F.avg(F.when(condition, value))


def step_bin(value: Column, edges: Sequence[float]) -> Column:
    """Index of the left-closed bin `[edge, next edge)`; `len(edges) - 1` for all else.

    Null and values outside the edges share the last index, which therefore sorts
    behind every regular bin.
    """
    last = len(edges) - 1
    chain = F.when(value.isNull(), F.lit(last))
    for index, (low, high) in enumerate(zip(edges, edges[1:])):
        chain = chain.when((value >= low) & (value < high), F.lit(index))
    return chain.otherwise(F.lit(last))


def bin_label(index: Column, labels: Sequence[str]) -> Column:
    """Name of a bin index."""
    return F.element_at(F.array(*[F.lit(label) for label in labels]), index + 1)


def right_closed_bin(value: Column, uppers: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin `(previous upper, upper]`; the last label takes the rest."""
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, label in zip(uppers, labels):
        chain = chain.when(value <= upper, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def is_fall(delta: Column, null_as_down: bool = True) -> Column:
    """True for a negative change.

    Where missing values sort below every number, a missing change counts as a
    fall too; `null_as_down=False` gives the plain comparison.
    """
    fall = F.coalesce(delta < 0, F.lit(False))
    return fall | delta.isNull() if null_as_down else fall
