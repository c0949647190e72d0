"""Connected components of links, every round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plaudit.session import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame, all_sides: bool) -> DataFrame:
    """Hang the partners of every node below the smallest node in sight.

    `pairs` lists each node `a` with its partners `b`.  With `all_sides` the larger
    partners move (large star), otherwise the smaller ones and the node itself do.
    """
    # A hub is reduced to its minimum before the shuffle; its rows meet that one row in a join,
    # which adaptive execution splits if the hub holds much of the data.
    roots = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    met = pairs.join(roots, "a")
    if all_sides:
        moved = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        moved = met.select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(
            roots.select("a", F.col("root").alias("b"))
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every node with a link; root is the smallest node of the component.

    `edges` has the columns `a`, `b` of one comparable type; nulls, loops and repeats are
    ignored, no edges give no rows.  Large and small stars alternate until the edges
    stand still, which takes about log(nodes) rounds also for long chains.
    """
    linked = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    state = cut_lineage(
        linked.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    mark = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("b", "a").cast("long")))
    before = None
    while True:
        large = _star(_both_ways(state), True)
        # Large star leaves every node below smaller ones only, so a > b throughout.
        state = cut_lineage(_star(cut_lineage(large, "edges"), False), "edges")
        now = state.agg(mark.alias("mark")).first()["mark"]
        if now == before:
            break
        before = now
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
