"""Degree, PageRank and sampled betweenness."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plaudit.functions.texts import digest
from plaudit.operators.graph import project
from plaudit.operators.skew import HotKeys
from plaudit.session import cut_lineage


def friend_degree(users: DataFrame, friendships: DataFrame, isolated: int = 0) -> DataFrame:
    """`user_id`, `degree`: incident friendships, either direction.

    `isolated` is the value of users without any; pass 1 to reproduce an optional
    match that counts the unmatched row itself.
    """
    counts = (
        project(friendships, "user_id", "friend_id", "undirected")
        .groupBy(F.col("src").alias("user_id"))
        .agg(F.count(F.lit(1)).alias("degree"))
    )
    return (
        users.select("user_id")
        .join(counts, "user_id", "left")
        .withColumn("degree", F.coalesce("degree", F.lit(isolated).cast("long")))
    )


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    iterations: int = 20,
    damping: float = 0.85,
    tolerance: float = 1e-7,
    **hot_limits,
) -> DataFrame:
    """Weighted PageRank, not normalised: `(1 - d) + d * sum(rank * weight share)`.

    `vertices` has `id`, `edges` has `src`, `dst`, `w`.  Parallel edges merge into
    one transition.  Stops early once no rank moves by more than the tolerance,
    which on a graph without paths of length two is after one round.
    """
    weights = edges.groupBy("src", "dst").agg(F.sum("w").alias("w"))
    leaving = edges.groupBy("src").agg(F.sum("w").alias("out"))
    moves = cut_lineage(
        HotKeys.find(edges, "src", **hot_limits)
        .join(weights, leaving, ["dst"])
        .select("src", "dst", F.try_divide("w", "out").alias("share")),
        "moves",
    )
    spread = HotKeys.find(moves, "src", **hot_limits)
    base = 1.0 - damping
    ranks = cut_lineage(vertices.select("id", F.lit(base).alias("rank")), "ranks")
    for _ in range(iterations):
        received = (
            spread.join(moves, ranks, ["dst"], lookup_key="id")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum(F.col("rank") * F.col("share")).alias("received"))
        )
        fresh = ranks.join(received, "id", "left").select(
            "id",
            (F.lit(base) + damping * F.coalesce("received", F.lit(0.0))).alias("rank"),
            F.col("rank").alias("previous"),
        )
        fresh = cut_lineage(fresh, "ranks")
        moved = fresh.agg(F.max(F.abs(F.col("rank") - F.col("previous")))).first()[0]
        ranks = fresh.select("id", "rank")
        if moved is None or moved <= tolerance:
            break
    return ranks


def business_pagerank(businesses: DataFrame, reviewed: DataFrame, weighted: bool, **options) -> DataFrame:
    """`business_id`, `pagerank` on the graph of users reviewing businesses."""
    edges = project(reviewed, "user_id", "business_id", weight="stars" if weighted else None)
    # Every user is the source of its own edges only; those without edges have no effect.
    vertices = (
        edges.select(F.col("src").alias("id"))
        .union(businesses.select("business_id"))
        .distinct()
    )
    ranks = pagerank(vertices, edges, **options)
    return businesses.select(F.col("business_id").alias("id")).join(ranks, "id").select(
        F.col("id").alias("business_id"), F.col("rank").alias("pagerank")
    )


def sampled_sources(vertices: DataFrame, sources: int | None, seed: int = 42) -> DataFrame:
    """The starting vertices: all, or a fixed number in hash order of their ids."""
    ids = vertices.select("id")
    if sources is None:
        return ids
    return ids.orderBy(digest("id", seed=seed), "id").limit(sources)


def betweenness(
    vertices: DataFrame,
    edges: DataFrame,
    sources: int | None = 250,
    batch: int = 250,
    seed: int = 42,
    **hot_limits,
) -> DataFrame:
    """`id`, `score`: shortest-path betweenness from sampled sources, undirected.

    `edges` holds both directions.  Breadth-first levels of all sources of a batch
    advance together as rows keyed by vertex; path counts go forward,
    dependencies come back level by level (Brandes 2001, with source sampling after
    Brandes and Pich 2007).  Undirected paths are met from both ends, so the sum is
    halved; there is no scaling by the share of sources.
    """
    steps = cut_lineage(
        edges.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct(), "steps"
    )
    spread = HotKeys.find(steps, "src", **hot_limits)
    chosen = cut_lineage(sampled_sources(vertices, sources, seed), "sources")
    groups = max(1, -(-(chosen.count() if sources is None else sources) // batch))
    totals = None
    for group in range(groups):
        start = chosen.filter(F.pmod(F.xxhash64("id"), F.lit(groups)) == group)
        part = _dependencies(start, steps, spread)
        totals = part if totals is None else totals.unionByName(part)
    summed = totals.groupBy("id").agg((F.sum("delta") / 2).alias("score"))
    return (
        vertices.select("id")
        .join(summed, "id", "left")
        .withColumn("score", F.coalesce("score", F.lit(0.0)))
    )


# At most so many numbers are summed at a time: vertices of a part times sources.
CELLS = 1_000_000
# Roles of the rows that meet at a vertex: sent along an edge, or known there.
SENT, KNOWN, PAST = 0, 1, 2


def _parts(batches: Iterator[pa.RecordBatch], sources: int) -> Iterator[tuple]:
    """Rows in short parts: node, number of the node within the part, role, and their entries as row, source and value."""
    rows = max(1, CELLS // sources)
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            part = batch.slice(begin, rows)
            coded = part.column(0).dictionary_encode()
            at, value = part.column(2), part.column(3)
            row = np.repeat(np.arange(part.num_rows), at.value_lengths().to_numpy())
            entries = row, at.flatten().to_numpy(), value.flatten().to_numpy()
            yield coded.dictionary, coded.indices.to_numpy(), part.column(1).to_numpy(), entries


def _lists(held: np.ndarray, values: np.ndarray) -> list[pa.Array]:
    """Per row the sources that are held and their values."""
    ends = np.concatenate([[0], np.cumsum(held.sum(axis=1))]).astype(np.int32)
    at = np.nonzero(held)[1].astype(np.int32)
    return [pa.ListArray.from_arrays(ends, pa.array(at)), pa.ListArray.from_arrays(ends, pa.array(values[held]))]


def _added(sources: int):
    """Sums the rows of one role by vertex, part by part, before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, node, role, (row, at, value) in _parts(batches, sources):
            cells = node[row] * np.int64(sources) + at
            shape = (len(nodes), sources)
            sums = np.bincount(cells, value, len(nodes) * sources).reshape(shape)
            held = np.bincount(cells, minlength=len(nodes) * sources).reshape(shape) > 0
            roles = pa.array(np.full(len(nodes), SENT, np.int32))
            yield pa.RecordBatch.from_arrays([nodes, roles, *_lists(held, sums)], ["node", "role", "at", "value"])

    return run


def _met(sources: int, decide):
    """Sums per vertex and source what was sent there; rows come in order of their node.

    `decide` gets matrices by vertex and source (sums, what was sent, the known values, what is known, what
    is past) and says which entries stay, their values, and a number per vertex.
    """
    names = ["node", "at", "value", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for nodes, node, role, (row, at, value) in _parts(batches, sources):
            shape, role_of = (len(nodes), sources), role[row]
            cells = node[row] * np.int64(sources) + at

            def matrix(which: int, weights: bool) -> np.ndarray:
                mine = role_of == which
                return np.bincount(cells[mine], value[mine] if weights else None, shape[0] * sources).reshape(shape)

            found = [matrix(SENT, True), matrix(SENT, False) > 0, matrix(KNOWN, True), matrix(KNOWN, False) > 0, matrix(PAST, False) > 0]
            if last is not None and nodes[0] == last[0]:
                for mine, before in zip(found, held):
                    mine[0] = mine[0] + before[0]
            elif last is not None:
                yield pa.RecordBatch.from_arrays([last, *decide(*held)], names)
            # The last vertex may go on in the next part.
            done = len(nodes) - 1
            if done:
                yield pa.RecordBatch.from_arrays([nodes.slice(0, done), *decide(*[m[:done] for m in found])], names)
            last, held = nodes.slice(done), [m[done:].copy() for m in found]
        if last is not None:
            yield pa.RecordBatch.from_arrays([last, *decide(*held)], names)

    return run


def _ahead(paths, sent, known_paths, known, past):
    """Vertices one step ahead with their path counts.

    An undirected step leads to the next level, the same level or the one before; what those two hold has been seen.
    """
    return [*_lists(sent & ~known & ~past, paths), pa.nulls(len(paths), pa.float64())]


def _back(shares, sent, paths, known, past):
    """The shares a vertex passes back, and its dependencies: shares that arrived, times own paths.

    Shares that arrive at vertices of other levels find no paths and drop out.
    """
    delta = np.where(known, paths * shares, 0.0)
    return [*_lists(known, (1.0 + delta) / np.where(known, paths, 1.0)), pa.array(delta.sum(axis=1))]


def _dependencies(start: DataFrame, steps: DataFrame, spread: HotKeys) -> DataFrame:
    """Sum of dependencies per vertex over the given sources.

    A level is a table of vertices, each with the sources that reach it and the number of paths from them
    as two lists, so an edge carries what it passes on as one row for all sources.
    """
    # About a batch of ids, one task numbers them.
    numbered = cut_lineage(
        start.select("id").na.drop().distinct().withColumn("at", F.row_number().over(Window.orderBy("id")) - 1), "numbered"
    )
    sources = max(1, numbered.count())
    kind = dict(start.dtypes)["id"]
    one = lambda c: F.array(c)
    level = numbered.select(F.col("id").alias("node"), one(F.col("at")).alias("at"), one(F.lit(1.0)).alias("value"))
    levels = [cut_lineage(level, "level")]

    def meet(values: DataFrame, seen: dict[int, DataFrame], decide) -> DataFrame:
        # Neither side travels through the driver, whatever its files suggest.
        sent = spread.join(steps.hint("merge"), values, ["dst"], lookup_key="node")
        rows = sent.select(F.col("dst").alias("node"), F.lit(SENT).alias("role"), "at", "value")
        if spread.values:
            # Of what goes to a hub, a task keeps one row for each of its parts.
            rows = rows.mapInArrow(_added(sources), f"node {kind}, role int, at array<int>, value array<double>")
        for role, known in seen.items():
            rows = rows.unionByName(known.select("node", F.lit(role).alias("role"), "at", "value"))
        dealt = rows.repartition("node").sortWithinPartitions("node")
        return dealt.mapInArrow(_met(sources, decide), f"node {kind}, at array<int>, value array<double>, total double")

    while True:
        seen = {KNOWN: levels[-1]} if len(levels) == 1 else {KNOWN: levels[-1], PAST: levels[-2]}
        ahead = meet(levels[-1], seen, _ahead).filter(F.size("at") > 0).drop("total")
        ahead = cut_lineage(ahead, "level")
        if ahead.isEmpty():
            break
        levels.append(ahead)

    # The source itself, level zero, depends on nothing.
    collected = start.select("id", F.lit(0.0).alias("delta"))
    behind = None
    for here in reversed(levels[1:]):
        if behind is None:
            # Nothing lies beyond the last level.
            behind = here.select("node", "at", F.transform("value", lambda paths: 1.0 / paths).alias("value"))
            continue
        known = meet(behind, {KNOWN: here}, _back).filter(F.size("at") > 0)
        behind = cut_lineage(known, "delta")
        collected = collected.unionByName(behind.select(F.col("node").alias("id"), F.col("total").alias("delta")))
    return collected.groupBy("id").agg(F.sum("delta").alias("delta"))
