"""Approximate nearest neighbours by largest inner product, with a few stable projections.

Every vector x gets one more component that makes all norms equal, so the largest inner product is the
smallest distance.  Gaussian (2-stable) projections to `dimensions` numbers turn the squared
distance d^2 into d^2 times a chi-square variable.  Each block of vectors is indexed by a
kd-tree over its projections; a query takes the leaves in order of their projected distance,
verifies all vectors of a leaf on the originals, and stops once a vector nearer than its
20th best (21st with itself) would have been projected that far out only with probability `miss` or less.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plaudit.operators.topk import top_per_group
from plaudit.session import cut_lineage


# Queries that walk an index side by side.
QUERY_ROWS = 512


@dataclass(frozen=True)
class Search:
    """nearest: neighbours per query.  dimensions: projections.  leaf: most vectors of a leaf.
    miss: chance of missing a neighbour accepted when stopping.  block: vectors per index.
    queries: queries searched in one index at once.
    """

    nearest: int = 20
    dimensions: int = 8
    leaf: int = 256
    miss: float = 0.01
    block: int = 16_384
    queries: int = 2_048
    seed: int = 5


def chi_square_quantile(probability: float, degrees: int) -> float:
    """Quantile of chi-square with an even number of degrees, whose distribution is a finite sum."""
    if degrees % 2:
        raise ValueError("an even number of projections is needed")

    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - np.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < probability else (low, middle)
    return low


def kd_leaves(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Rows of each leaf of a kd-tree that halves the widest side at its median."""
    open_, leaves = [np.arange(len(points))], []
    while open_:
        rows = open_.pop()
        if len(rows) <= leaf:
            leaves.append(rows)
            continue
        side = points[rows]
        widest = int(np.argmax(side.max(axis=0) - side.min(axis=0)))
        order = np.argpartition(side[:, widest], len(rows) // 2)
        open_ += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return leaves


def exact_scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order wherever its vector stands."""
    return (vectors * query).sum(axis=1)


def _best(query: np.ndarray, own: int, ids: np.ndarray, vectors: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of a block given rough scores (-inf where unseen); ties to smaller ids."""
    seen = np.flatnonzero((rough > -np.inf) & (ids != own))
    if len(seen) > k:
        bar = np.partition(rough[seen], len(seen) - k)[len(seen) - k]
        seen = seen[rough[seen] >= bar - 1e-9 * (1 + abs(bar))]
    scores = exact_scores(query, vectors[seen])
    order = np.lexsort((ids[seen], -scores))[:k]
    return ids[seen][order], scores[order]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, how: Search) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, ids, scores) of the nearest vectors of one block found for each query."""
    random = np.random.Generator(np.random.PCG64(how.seed))
    axes = random.standard_normal((vectors.shape[1] + 1, how.dimensions))
    squares = (vectors**2).sum(axis=1)
    longest = squares.max()
    points = np.column_stack([vectors, np.sqrt(np.maximum(longest - squares, 0))]) @ axes
    leaves = kd_leaves(points, how.leaf)
    low = np.array([points[rows].min(axis=0) for rows in leaves])
    high = np.array([points[rows].max(axis=0) for rows in leaves])
    quantile = chi_square_quantile(1 - how.miss, how.dimensions)
    for start in range(0, len(queries), QUERY_ROWS):
        some = queries[start : start + QUERY_ROWS]
        projected = some @ axes[:-1]
        outside = np.maximum(np.maximum(low[None] - projected[:, None], projected[:, None] - high[None]), 0)
        reach = (outside**2).sum(axis=2)
        order = np.argsort(reach, axis=1, kind="stable")
        rough = np.full((len(some), len(ids)), -np.inf)
        kth = np.full(len(some), -np.inf)
        norms = (some**2).sum(axis=1)
        own = query_ids[start : start + QUERY_ROWS]
        live, begin, count = np.arange(len(some)), 0, 1
        # Every round takes twice as many leaves of each query as the one before, in its own order.
        while begin < len(leaves) and len(live):
            at = order[live, begin : begin + count]
            # Squared distance of the k-th best so far; infinite until there are k.
            limit = np.where(np.isfinite(kth[live]), np.maximum(norms[live] + longest - 2 * kth[live], 0), np.inf)
            near = np.take_along_axis(reach[live], at, axis=1) <= (quantile * limit)[:, None]
            for leaf in np.unique(at[near]):
                of = live[((at == leaf) & near).any(axis=1)]
                rough[of[:, None], leaves[leaf][None, :]] = some[of] @ vectors[leaves[leaf]].T
            live = live[near.all(axis=1)]
            begin, count = begin + count, 2 * count
            if begin < len(leaves) and len(ids) > how.nearest:
                # One more than wanted, because the query itself may be among them.
                kth[live] = np.partition(rough[live], len(ids) - how.nearest - 1, axis=1)[:, len(ids) - how.nearest - 1]
        for i in range(len(some)):
            yield (int(own[i]), *_best(some[i], own[i], ids, vectors, rough[i], how.nearest))


def nearest(vectors: DataFrame, is_query, id_column: str = "vec_id", vector_column: str = "embedding", how: Search = Search()) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score` of the nearest vectors found for every query.

    `is_query` is a condition on the id.  Vectors that are null, empty, zero or hold null, NaN or
    infinite components take no part, nor do rows without an id.  Vectors of another length than
    the query's are no neighbours of it.  A row with the query's id is never its neighbour; of rows that
    repeat an id the one with the smallest vector counts.  Ties go to the smaller id.
    """
    x = F.col(f"`{vector_column}`")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    usable = x.isNotNull() & (F.size(x) > 0) & F.forall(x, finite) & F.exists(x, lambda v: v != 0)
    chosen = vectors.filter(usable & F.col(f"`{id_column}`").isNotNull()).select(
        F.col(f"`{id_column}`").cast("long").alias("id"), x.cast("array<double>").alias("x")
    )
    chosen = chosen.groupBy("id").agg(F.min("x").alias("x")).withColumn("size", F.size("x"))
    chosen = cut_lineage(chosen, "vectors")
    rows = chosen.count()
    queries = chosen.filter(is_query(F.col("id")))
    blocks = max(1, -(-rows // how.block))
    parts = max(1, -(-queries.count() // how.queries))
    # Every block of queries meets every block of vectors: the stated query set against all rows.
    block_of = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    part_of = F.pmod(F.xxhash64("id", F.lit("query")), F.lit(parts)).cast("int")
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sides = (
        chosen.select(block_of.alias("block"), everywhere(parts).alias("part"), F.lit(False).alias("asks"), "size", "id", "x")
        .unionByName(queries.select(everywhere(blocks).alias("block"), part_of.alias("part"), F.lit(True).alias("asks"), "size", "id", "x"))
    )

    def run(table: pa.Table) -> pa.Table:
        x = np.array(table.column("x").to_pylist(), float)
        ids, asks = table.column("id").to_numpy(), np.array(table.column("asks").to_pylist())
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if asks.any() and not asks.all():
            for query, near, scores in search_block(ids[asks], x[asks], ids[~asks], x[~asks], how):
                out.append((np.full(len(near), query), near, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query_id": columns[0].astype(np.int64), "vec_id": columns[1].astype(np.int64), "score": columns[2]})

    found = sides.groupBy("block", "part", "size").applyInArrow(run, "query_id bigint, vec_id bigint, score double")
    return top_per_group(found, ["query_id"], "score", ["vec_id"], how.nearest, place="rank").select("query_id", "rank", "vec_id", "score")
