"""Equi-joins that hold up when a few keys own a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SALT = "__salt"
# A key is worth splitting once it fills more than this share of the rows ...
HOT_SHARE = 0.002
# ... and at least this many rows; smaller groups fit one task comfortably.
HOT_ROWS = 1_000_000
FANOUT = 64


@dataclass(frozen=True)
class HotKeys:
    """The keys of one column that are too large for a single task.

    At most `1 / share` keys can exceed the share, so the list is bounded by a
    constant no matter how large the data is.
    """

    column: str
    values: tuple
    fanout: int = FANOUT

    @classmethod
    def find(
        cls,
        facts: DataFrame,
        column: str,
        share: float = HOT_SHARE,
        min_rows: int = HOT_ROWS,
        fanout: int = FANOUT,
    ) -> HotKeys:
        rows = facts.count()
        floor = max(min_rows, int(rows * share))
        if rows <= floor:
            return cls(column, (), fanout)
        hot = (
            facts.groupBy(column)
            .count()
            .filter((F.col("count") > floor) & F.col(column).isNotNull())
            .select(column)
            .collect()
        )
        return cls(column, tuple(row[0] for row in hot), fanout)

    def _is_hot(self, column: Column) -> Column:
        return column.isin(list(self.values))

    def join(
        self,
        facts: DataFrame,
        lookup: DataFrame,
        spread_by: Sequence[str],
        how: str = "inner",
        lookup_key: str | None = None,
    ) -> DataFrame:
        """Join `facts` to `lookup` on the key, spreading hot fact rows over salts.

        The salt is a hash of `spread_by`, so a repeated task makes the same
        choice.  Only the lookup rows of hot keys are replicated.
        """
        key = self.column
        if lookup_key and lookup_key != key:
            lookup = lookup.withColumnRenamed(lookup_key, key)
        if not self.values:
            return facts.join(lookup, key, how)
        salted = facts.withColumn(
            SALT,
            F.when(
                self._is_hot(F.col(key)),
                F.pmod(F.xxhash64(*spread_by), F.lit(self.fanout)).cast("int"),
            ).otherwise(F.lit(0)),
        )
        every_salt = F.array(*[F.lit(i) for i in range(self.fanout)])
        copies = lookup.withColumn(
            SALT,
            F.explode(F.when(self._is_hot(F.col(key)), every_salt).otherwise(F.array(F.lit(0)))),
        )
        return salted.join(copies, [key, SALT], how).drop(SALT)


def hot_key_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    **limits,
) -> DataFrame:
    """Many-to-few join that measures the fact side first and splits its hot keys."""
    return HotKeys.find(facts, key, **limits).join(facts, lookup, spread_by, how)


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    fanout: int = 16,
) -> DataFrame:
    """Many-to-few join with a fixed salt.

    For fact sides that are computed on the spot, where a counting pass would
    repeat the computation, and lookups that are far smaller than the facts.
    """
    salted = facts.withColumn(SALT, F.pmod(F.xxhash64(*spread_by), F.lit(fanout)).cast("int"))
    copies = lookup.withColumn(SALT, F.explode(F.array(*[F.lit(i) for i in range(fanout)])))
    return salted.join(copies, [key, SALT], how).drop(SALT)
