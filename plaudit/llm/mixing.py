"""Mixing sources to target weights, to the word.

Rows get a hash-random key and are ranged by its leading digits within their source, so a
source of any size is spread over many ranges.  The words of the ranges below and of the rows
before in the same range add up to the words before a row; the source is cut where its budget
ends, after as many whole epochs as the budget holds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from plaudit.session import cut_lineage

# Fixed value: the word pattern.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
RANGE_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(row_id: Column, seed: int) -> Column:
    """32 hexadecimal digits that look random and are the same in every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("null"))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Add `target` to one row per source (`place` sorts them, `source_size`).

    The weights repeat in order of `place`.  The total is shared by weight; a source stops at
    `most` times its size and what exceeds goes to the others by weight.  With the sources
    in order of `most * size / weight`, exactly those stop whose quotient is below the share
    per weight that remains when all before them have stopped.
    """
    ordered = Window.orderBy("place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1)
    weighed = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    by_quotient = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    below = by_quotient.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_quotient.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0))) / F.sum("weight").over(onward)
    placed = weighed.withColumn("share", share).withColumn("stops", F.col("cap") / F.col("weight") < F.col("share"))
    # The shares of the sources that do not stop never fall below the first one's.
    last = F.min(F.when(~F.col("stops"), F.struct(F.col("cap") / F.col("weight"), "place", "share"))).over(everything)
    return (
        placed.withColumn("last", last["share"])
        .withColumn("target", F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("last")))
        .drop("weight", "cap", "share", "stops", "last")
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = 1, row_column: str | None = None) -> DataFrame:
    """Per row: id, source, `size` in words, `source_size`, `target` and `taken`, the words the mix takes.

    A row may be taken up to `most` times; the last row of a source may be taken in part, so a
    source's taken words are its target, rounded down.  Null texts have no words; a null source
    is a source of its own, ordered last.  Repeated rows count each by itself; `row_column`, if
    named, tells them apart, breaks ties of their order and is given out too.
    """
    row = [F.col(f"`{row_column}`").alias("row")] if row_column else []
    # "0" and the name sorts by code point, "1" after all names.
    place = F.coalesce(F.concat(F.lit("0"), F.col(f"`{source_column}`").cast("string")), F.lit("1"))
    rows = cut_lineage(
        docs.select(
            F.col(f"`{id_column}`").alias("id"),
            F.col(f"`{source_column}`").alias("source"),
            place.alias("place"),
            word_count(F.col(f"`{text_column}`")).alias("size"),
            random_key(F.col(f"`{id_column}`"), seed).alias("key"),
            *row,
        ),
        "sized",
    )
    # The number of ranges follows the rows; it changes the layout, never the result.
    digits = max(1, math.ceil(math.log(max(rows.count(), 1) / RANGE_ROWS, 16))) if rows.count() > RANGE_ROWS else 1
    rows = rows.withColumn("range", F.substring("key", 1, digits))
    sums = cut_lineage(rows.groupBy("place", "range").agg(F.sum("size").alias("words")), "ranges")
    budgets = targets(sums.groupBy("place").agg(F.sum("words").alias("source_size")), weights, most)
    lower = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("below", F.coalesce(F.sum("words").over(lower), F.lit(0))).join(budgets, "place")
    before = Window.partitionBy("place", "range").orderBy("key", "id", "size", *(["row"] if row else [])).rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    return (
        rows.join(offsets.drop("words"), ["place", "range"])
        .withColumn("before", F.col("below") + F.coalesce(F.sum("size").over(before), F.lit(0)))
        .select(
            F.col("id").alias(id_column),
            F.col("source").alias(source_column),
            "size",
            "source_size",
            "target",
            (epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", rest - F.col("before")))).cast("long").alias("taken"),
            *([F.col("row").alias(row_column)] if row else []),
        )
    )


def place_of(source: Column) -> Column:
    """"0" and the name sorts by code point, "1" (null) after all names."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def row_key(columns: list[str], seed: int = 1) -> Column:
    """32 hexadecimal digits that look random and depend on all contents of a row, so a repeated id is no hot key."""
    contents = [F.xxhash64(F.lit(i), *[F.col(f"`{c}`") for c in columns]).cast("string") for i in range(2)]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *contents))


def cuts(docs: DataFrame, text_column: str = "text", source_column: str = "source",
         weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = 1) -> DataFrame:
    """The mix as one row per source, from which every row can be decided where it lies (`taken_of`).

    `place` is `place_of` the source; the mix takes every row `epochs` times, rows whose
    `row_key` over all columns is below `cut` once more, and `cut_words` words of a row at the cut.
    Rows equal in all columns share what falls to them equally, rounded down.  No rows give no cuts.
    """
    rows = cut_lineage(
        docs.select(place_of(F.col(f"`{source_column}`")).alias("place"), word_count(F.col(f"`{text_column}`")).alias("size"),
                    row_key(docs.columns, seed).alias("key")),
        "sized",
    )
    n = rows.count()
    digits = max(1, math.ceil(math.log(n / RANGE_ROWS, 16))) if n > RANGE_ROWS else 1
    rows = rows.withColumn("range", F.substring("key", 1, digits))
    sums = cut_lineage(rows.groupBy("place", "range").agg(F.sum("size").alias("words")), "ranges")
    budgets = targets(sums.groupBy("place").agg(F.sum("words").alias("source_size")), weights, most)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budgets = budgets.withColumn("epochs", epochs).withColumn("rest", (budget - F.col("epochs") * F.col("source_size")).cast("long"))
    lower = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    below = sums.withColumn("below", F.coalesce(F.sum("words").over(lower), F.lit(0)))
    at_cut = (F.col("below") <= F.col("rest")) & (F.col("below") + F.col("words") > F.col("rest"))
    cut_range = below.join(budgets, "place").filter(at_cut).select("place", "range", "below", "rest")
    # Only the range that holds a source's cut is put in order.
    inside = rows.join(cut_range, ["place", "range"]).groupBy("place", "key", "size", "below", "rest").agg(F.count(F.lit(1)).alias("copies"))
    before = Window.partitionBy("place").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("size") * F.col("copies")
    reached = inside.withColumn("before", F.col("below") + F.coalesce(F.sum(words).over(before), F.lit(0))).filter(
        (F.col("before") <= F.col("rest")) & (F.col("before") + words > F.col("rest"))
    )
    ends = reached.select("place", F.col("key").alias("cut"), F.floor((F.col("rest") - F.col("before")) / F.col("copies")).alias("cut_words"))
    return cut_lineage(budgets.join(ends, "place", "left").select("place", "source_size", "target", "epochs", "cut", "cut_words"), "cuts")


def taken_of(size: Column, key: Column) -> Column:
    """Words taken of a row that has met the cut of its source."""
    once_more = F.when(key < F.col("cut"), size).when(key == F.col("cut"), F.col("cut_words")).otherwise(F.lit(0))
    return (F.col("epochs") * size + F.coalesce(once_more, F.lit(0))).cast("long")


MIX_SQL = f"""
WITH sized AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS place,
           CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
           md5('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
    FROM documents),
sources AS (
    SELECT place, CAST(sum(size) AS BIGINT) AS source_size,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY place) - 1) % 3] AS weight
    FROM sized GROUP BY place),
shared AS (
    SELECT *, CAST(source_size * 3 AS DOUBLE) / weight AS quotient,
           CAST((SELECT sum(source_size) FROM sources) - coalesce(sum(source_size * 3) OVER below, 0) AS DOUBLE)
               / sum(weight) OVER onward AS share
    FROM sources
    WINDOW below AS (ORDER BY source_size * 3 / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           onward AS (ORDER BY source_size * 3 / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
budgets AS (
    SELECT place, source_size,
           CASE WHEN quotient < share THEN CAST(source_size * 3 AS DOUBLE)
                ELSE weight * (SELECT arg_min(share, (quotient, place)) FROM shared WHERE NOT quotient < share)
           END AS target
    FROM shared),
summed AS (
    SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
           CAST(sum(size) OVER (PARTITION BY place ORDER BY key, doc_id, size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS before
    FROM sized JOIN budgets USING (place))
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE budget // source_size * size
                 + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM summed
"""
