"""Near-duplicate vectors by sorted projection passes.

1. Equal vectors of a label form a class; only classes are compared.
2. In every pass a class gets a new key: one bit per random direction, the sign of its product.
   Classes are ordered by label and key, so similar ones stand close together.
3. Every class is compared with those up to `window` places further on.  Classes that agree in
   the leading bits of the key form a run; a run longer than the window is compared as a whole,
   pair of blocks by pair of blocks, so dense groups of any size are covered.
4. Every class carries its place and run in all passes.  A pair counts in the first pass that
   brings it together, so links are counted without a list of pairs.  A task gives out a count
   per class and the links of a spanning forest; the forests of all passes are united.

The number of bits makes an evenly spread label fit the window run by run, and the number of
passes follows from the chance that a pair at the threshold agrees in so many bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plaudit.llm.components import components
from plaudit.session import cut_lineage

# Bits of a key; it stays a positive 64-bit number.
KEY_BITS = 62
STRIP = 256
FOUND = "a bigint, b bigint, n bigint"


@dataclass(frozen=True)
class SortedPasses:
    """cosine: least cosine of a link.  window: places compared.  block: most classes compared by
    one task besides a window.  unseen: chance that no pass brings a pair at the threshold into one run.
    """

    cosine: float = 0.98
    window: int = 512
    block: int = 2048
    unseen: float = 1e-4
    seed: int = 12

    def bits(self, largest: int) -> int:
        """Leading bits that define a run, for the largest label."""
        return min(KEY_BITS, max(0, math.ceil(math.log2(max(largest, 1) / self.window))))

    def passes(self, largest: int) -> int:
        together = (1 - math.acos(self.cosine) / math.pi) ** self.bits(largest)
        return 1 if together >= 1 else math.ceil(math.log(self.unseen) / math.log1p(-together))


def _directions(turn: int, size: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, turn, size])).standard_normal((size, KEY_BITS))


def sign_keys(vectors: np.ndarray, turn: int, seed: int) -> np.ndarray:
    """The concatenated signs of the products with the directions of a pass, the first one leading."""
    signs = vectors @ _directions(turn, vectors.shape[1], seed) >= 0
    return signs.astype(np.int64) @ (np.int64(1) << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64))


def _rows_of(column: pa.Array) -> list[np.ndarray]:
    """The arrays of a list column without nulls."""
    ends = column.value_lengths().to_numpy(zero_copy_only=False).cumsum()
    return np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1])


def _classes(rows: DataFrame) -> DataFrame:
    """`id`, `class` and, where the vector takes part, `label`, `x`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for label, x in zip(batch.column(1).to_pylist(), batch.column(2)):
                if x.is_valid:
                    digest = hashlib.blake2b(x.values.to_numpy(zero_copy_only=False).tobytes(), digest_size=16)
                    digest.update(repr(label).encode())
                    made.append(digest.digest())
                else:
                    made.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], ["id", "label", "x", "class"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(run, f"id {types['id']}, label {types['label']}, x array<double>, class binary")


def _keys(nodes: DataFrame, turns: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = _rows_of(batch.column(3))
            sizes = np.array([len(x) for x in vectors])
            keys = np.zeros((batch.num_rows, turns), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                some = np.array([vectors[i] for i in at])
                for turn in range(turns):
                    keys[at, turn] = sign_keys(some, turn, seed)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * turns), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], ["node", "label", "size", "keys"])

    kind = dict(nodes.dtypes)["label"]
    source = nodes.select("node", "label", "size", "x")
    return source.mapInArrow(run, f"node bigint, label {kind}, size int, keys array<bigint>")


def _places(nodes: DataFrame, turns: int, bits: int, seed: int) -> DataFrame:
    """`turn`, `node`, `run` and its place in one order of all passes, from a range sort and prefix sums of its parts."""
    spread = _keys(nodes, turns, seed).select("node", "label", "size", F.posexplode("keys").alias("turn", "key"))
    order = ["turn", "label", "size", "key", "node"]
    number = F.monotonically_increasing_id()
    ranged = cut_lineage(
        spread.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "turn", "label", "size", "node", F.shiftright("key", KEY_BITS - bits).alias("run"),
            F.shiftright(number, 33).alias("part"), number.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
        ),
        "order",
    )
    # One row per part of the sort.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    return ranged.join(starts, "part").select("turn", "label", "size", "node", "run", (F.col("start") + F.col("at")).alias("place"))


def _forest(count: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it hangs together with) for all nodes but those smallest ones."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(count))
    return moved, root[moved]


def _compare(table: pa.Table, turn: int, how: SortedPasses) -> pa.Table:
    """Counts per class (`b` null) and a spanning forest (`n` null) of the links first met in this pass."""
    places = np.array(table.column("places").to_pylist(), np.int64)
    order = np.argsort(places[:, turn], kind="stable")
    table, places = table.take(pa.array(order)), places[order]
    runs = np.array(table.column("runs").to_pylist(), np.int64)
    side, node, weight = (table.column(c).to_numpy() for c in ("side", "node", "n"))
    whole, single = table.column("whole")[0].as_py(), (side == 0).all()
    vectors = [np.array(x, float) for x in table.column("x").to_pylist()]
    _, space = np.unique([f"{len(x)} {label!r}" for x, label in zip(vectors, table.column("label").to_pylist())], return_inverse=True)
    found = []
    # Equal labels stand together in the order.
    for first in np.flatnonzero(np.r_[True, space[1:] != space[:-1]]):
        last = first + int(np.argmin(np.r_[space[first:] == space[first], False]))
        x = np.array(vectors[first:last])
        x /= np.linalg.norm(x, axis=1)[:, None]
        at = places[first:last, turn]
        for begin in range(0, len(x), STRIP):
            end = min(begin + STRIP, len(x))
            until = len(x) if whole else int(np.searchsorted(at, at[end - 1] + how.window, "right"))
            i, j = np.nonzero(x[begin:end] @ x[begin:until].T >= how.cosine - 1e-9)
            i, j = i + begin, j + begin
            gap = at[j] - at[i]
            if whole:
                # A window has compared what stands closer.
                right = gap > how.window if single else (np.abs(gap) > how.window) & (side[first + i] < side[first + j])
            else:
                right = (gap > 0) & (gap <= how.window) & (side[first + i] == 0)
            i, j = i[right], j[right]
            near = np.einsum("ij,ij->i", x[i], x[j]) >= how.cosine
            found.append((first + i[near], first + j[near]))
    a, b = (np.concatenate(c) for c in zip(*found))
    new = np.ones(len(a), bool)
    for earlier in range(turn):
        new &= (np.abs(places[a, earlier] - places[b, earlier]) > how.window) & (runs[a, earlier] != runs[b, earlier])
    a, b = a[new], b[new]
    counts = np.bincount(a, weight[b], len(node)) + np.bincount(b, weight[a], len(node))
    linked = np.flatnonzero(counts)
    tip, root = _forest(len(node), a, b)
    none = [None]
    return pa.table({
        "a": pa.array(np.concatenate([node[linked], node[tip]])),
        "b": pa.array(none * len(linked) + node[root].tolist(), pa.int64()),
        "n": pa.array(counts[linked].astype(np.int64).tolist() + none * len(tip), pa.int64()),
    })


def _comparison(turn: int, how: SortedPasses):
    def run(table: pa.Table) -> pa.Table:
        return _compare(table, turn, how)

    return run


def _meetings(members: DataFrame, long_runs: DataFrame, turn: int, how: SortedPasses) -> DataFrame:
    """The members of every task of a pass: windows over blocks of places, and pairs of blocks of long runs."""
    members = members.withColumn("place", F.col("places")[turn]).withColumn("run", F.col("runs")[turn])
    own = F.floor(F.col("place") / how.block)
    ahead = F.when(F.col("place") % how.block < how.window, F.array(own, own - 1)).otherwise(F.array(own))
    windows = members.withColumn("block", F.explode(ahead)).select(
        F.struct("block", F.lit(-1).cast("long").alias("low"), F.lit(-1).cast("long").alias("high")).alias("task"),
        F.lit(False).alias("whole"), (F.col("block") != own).cast("int").alias("side"), "node", "label", "x", "n", "places", "runs",
    )
    chunk = F.floor((F.col("place") - F.col("first")) / how.block)
    chunks = F.ceil(F.col("rows") / how.block)
    runs = members.join(long_runs.filter(F.col("turn") == turn).drop("turn"), ["label", "size", "run"]).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))
    )
    runs = runs.select(
        F.struct(F.col("first").alias("block"), F.least(chunk, "other").alias("low"), F.greatest(chunk, "other").alias("high")).alias("task"),
        F.lit(True).alias("whole"), (chunk > F.col("other")).cast("int").alias("side"), "node", "label", "x", "n", "places", "runs",
    )
    return windows.unionByName(runs)


def near_duplicate_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    how: SortedPasses = SortedPasses(),
) -> DataFrame:
    """One row per input row: its id, `n_links`, `component_id` and `kept`.

    Rows are compared when their labels are equal and not null and their vectors of one length;
    they are linked from a cosine of `how.cosine` in double precision.  A vector that is null,
    empty, zero or holds null, NaN or infinite components links with nothing.  `n_links` counts
    the other rows linked directly, equal ones included; `component_id` is the smallest id
    reachable and `kept` tells whether it is the row's own.  A null id counts as larger than
    all others.  Repeated ids stay as rows of their own.  An empty table gives no rows; other
    columns are not carried along and may have any name.
    """
    x = F.col(f"`{vector_column}`")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    label = F.col(f"`{label_column}`")
    usable = label.isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(x, finite) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), label.alias("label"), F.when(usable, x.cast("array<double>")).alias("x"))
    classed = _classes(rows)
    nodes = cut_lineage(
        classed.filter(F.col("class").isNotNull()).groupBy("class")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("x").alias("x"))
        .withColumn("size", F.size("x")).withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    largest = nodes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("rows")).agg(F.max("rows")).first()[0] or 0
    turns, bits = how.passes(largest), how.bits(largest)

    placed = cut_lineage(_places(nodes, turns, bits, how.seed), "places")
    long_runs = placed.groupBy("turn", "label", "size", "run").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    long_runs = cut_lineage(long_runs.filter(F.col("rows") > how.window), "runs")
    of_node = placed.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("turn", "place", "run"))).alias("all"))
    members = nodes.select("node", "label", "size", "x", "n").join(
        of_node.select("node", F.col("all.place").alias("places"), F.col("all.run").alias("runs")), "node"
    )
    members = cut_lineage(members, "members")
    found = None
    for turn in range(turns):
        met = _meetings(members, long_runs, turn, how).groupBy("task").applyInArrow(_comparison(turn, how), FOUND)
        met = cut_lineage(met, "links")
        found = met if found is None else found.unionByName(met)
    counts = found.filter(F.col("b").isNull()).groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    roots = cut_lineage(components(found.filter(F.col("b").isNotNull()).select("a", "b").distinct()), "roots")

    reached = nodes.select("class", "node", "id", "n").join(roots, "node", "left").join(counts, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    smallest = reached.groupBy("root").agg(F.min("id").alias("component_id"))
    by_class = reached.join(smallest, "root").select("class", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    named = classed.select("id", "class").join(by_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return named.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


LINKS_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, label, embedding::DOUBLE[] AS x,
         label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
         AND len(list_filter(embedding, lambda e: e <> 0)) > 0 AS usable
  FROM embeddings
), links AS (
  SELECT a.row AS a, b.row AS b
  FROM v a JOIN v b ON a.usable AND b.usable AND a.label = b.label AND len(a.x) = len(b.x) AND a.row <> b.row
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98
), reached AS (
  SELECT row, row AS other FROM v
  UNION
  SELECT r.row, l.b FROM reached r JOIN links l ON l.a = r.other
), counted AS (
  SELECT a AS row, count(*) AS n FROM links GROUP BY a
), rooted AS (
  SELECT r.row, min(v.vec_id) AS component_id FROM reached r JOIN v ON v.row = r.other GROUP BY r.row
)
SELECT v.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, r.component_id, v.vec_id IS NOT DISTINCT FROM r.component_id AS kept
FROM v JOIN rooted r USING (row) LEFT JOIN counted c USING (row)
"""
