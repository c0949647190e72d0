"""Random-projection node embeddings (after FastRP, Chen et al. 2019) and pair features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from plaudit.operators.skew import HotKeys
from plaudit.session import cut_lineage

# Vertices whose sums or vectors one task holds.
PART_VERTICES = 300_000
# Pairs whose products are made at a time.
PAIR_ROWS = 10_000
# What a task is sent: vectors of second ends first, then those of first ends with the pairs they are in.
HELD, ASKED = 0, 1
# Columns beside those that pairs bring along.
LEFT, RIGHT, ENTRIES = "__left", "__right", "__entries"


def sign_vector(key: Column, dimension: int, seed: int) -> Column:
    """Sparse random signs from a hash of the key: two thirds zeros, the rest +-sqrt(3/d).

    MD5 makes the signs reproducible in any SQL engine.
    """
    size = (3.0 / dimension) ** 0.5
    return F.transform(_signs(key, dimension, seed), lambda x: x * F.lit(size))


def _signs(key: Column, dimension: int, seed: int) -> Column:
    """The signs of `sign_vector` as 1, -1 and 0, a byte each."""

    def entry(place: Column) -> Column:
        text = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), place.cast("string")))
        draw = F.pmod(F.conv(F.substring(text, 1, 7), 16, 10).cast("long"), F.lit(6))
        return F.when(draw == 0, 1).when(draw == 1, -1).otherwise(0).cast("byte")

    return F.transform(F.sequence(F.lit(0), F.lit(dimension - 1)), entry)


def _norm(vector: Column) -> Column:
    """Length of a vector; 1 for the zero vector, so that it stays one when divided."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, norm).otherwise(F.lit(1.0))


def _bundled(steps: DataFrame, spread: HotKeys, vertices: int) -> DataFrame:
    """`dst`, `part`, `ids`: the steps as lists of their `src`, by the part of vertices that is summed together.

    There are as many parts as tasks run at a time, more if one would have to hold the sums of over
    `PART_VERTICES`.  What reaches a hub is summed in all parts; what a hub sends comes in several lists.
    """
    parts = max(steps.sparkSession.sparkContext.defaultParallelism, -(-vertices // PART_VERTICES), 1)
    # Steps go both ways, so the hubs are the same on either side.
    hub = lambda end: F.col(end).isin(list(spread.values)) if spread.values else F.lit(False)
    summed_by = F.when(hub("src"), F.col("dst")).otherwise(F.col("src"))
    piece = F.when(hub("dst"), F.pmod(F.xxhash64("src", F.lit(1)), F.lit(spread.fanout))).otherwise(F.lit(0))
    return cut_lineage(
        steps.groupBy("dst", F.pmod(F.xxhash64(summed_by), F.lit(parts)).alias("part"), piece.alias("piece"))
        .agg(F.collect_list("src").alias("ids"))
        .drop("piece"),
        "bundles",
    )


def _neighbour_sums(steps: DataFrame, state: DataFrame, spread: HotKeys, dimension: int) -> DataFrame:
    """`id`, `v`: sums of `v / norm` of `state` over all steps that leave `id`.

    A vector is dealt out once to every part that needs it, with the list of its neighbours there, and
    multiplied only where it is summed; with steps as `_bundled` returns them or one by one.
    """
    bundles = steps if "part" in steps.columns else _bundled(steps, spread, state.count())
    met = bundles.join(state.withColumnRenamed("id", "dst"), "dst").select("part", "ids", "v", "norm")
    dealt = met.repartition("part").select("part", F.explode("ids").alias("id"), "v", "norm")
    names = [f"v{i}" for i in range(1, dimension + 1)]
    found = dealt.groupBy("part", "id").agg(*[F.sum(F.element_at("v", i) / F.col("norm")).alias(n) for i, n in enumerate(names, 1)])
    if spread.values:
        found = found.groupBy("id").agg(*[F.sum(n).alias(n) for n in names])
    return found.select("id", F.array(*names).alias("v"))


def fast_rp(
    vertices: DataFrame,
    edges: DataFrame,
    dimension: int = 64,
    weights: Sequence[float] = (0.0, 1.0, 1.0),
    seed: int = 42,
    **hot_limits,
) -> DataFrame:
    """`id`, `embedding`: weighted sum of unit vectors of repeated neighbour means.

    `edges` (`src`, `dst`) holds both directions.  A mean and the sum it comes from have the same unit
    vector, so sums travel with their norm: the first are sums of signs and stay whole numbers.
    """
    steps = cut_lineage(edges.select("src", "dst").distinct(), "steps")
    spread = HotKeys.find(steps, "dst", **hot_limits)
    signs = vertices.select("id", _signs(F.col("id"), dimension, seed).alias("v"), F.lit(1.0).alias("norm"))
    state = cut_lineage(signs, "signs")
    bundles = _bundled(steps, spread, state.count())
    total = None
    for turn, weight in enumerate(weights):
        kind = "array<double>" if turn else "array<int>"
        sums = _neighbour_sums(bundles, state, spread, dimension).withColumn("v", F.col("v").cast(kind))
        reached = vertices.select("id").join(sums, "id", "left")
        filled = reached.select("id", F.coalesce("v", F.array_repeat(F.lit(0), dimension).cast(kind)).alias("v"))
        state = cut_lineage(filled.withColumn("norm", _norm(F.col("v"))), "vectors")
        if not weight:
            continue
        before = F.col("total") if total is not None else F.array_repeat(F.lit(0.0), dimension)
        total = (state if total is None else total.join(state, "id")).select(
            "id", F.zip_with(before, "v", lambda a, b: a + b / F.col("norm") * F.lit(weight)).alias("total")
        )
    if total is None:
        total = vertices.select("id", F.array_repeat(F.lit(0.0), dimension).alias("total"))
    return cut_lineage(total.select("id", F.col("total").alias("embedding")), "embedding")


def _products(kept: Sequence[str], cuts: Sequence[Sequence[float]] | None):
    """Products of the vectors of both ends of every pair; rows come by part, and in it the vectors that are held first."""

    def matrix(vectors: pa.ListArray) -> np.ndarray:
        return vectors.flatten().to_numpy().reshape(len(vectors), -1)

    def entries(products: np.ndarray) -> pa.ListArray:
        if cuts is None:
            flat = pa.array(products.ravel())
        else:
            flat = pa.array(np.column_stack([np.searchsorted(c, products[:, i]) for i, c in enumerate(cuts)]).astype(np.int8).ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(products) + 1, dtype=np.int32) * products.shape[1]), flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, vectors, known = None, [], [], None
        for batch in batches:
            part, role = batch.column("part").to_numpy(), batch.column("role").to_numpy()
            borders = [0, *(np.flatnonzero((np.diff(part) != 0) | (np.diff(role) != 0)) + 1), len(part)]
            for begin, end in zip(borders, borders[1:]):
                if begin == end:
                    continue
                if part[begin] != current:
                    current, ids, vectors, known = part[begin], [], [], None
                rows = batch.slice(begin, end - begin)
                if role[begin] == HELD:
                    ids.append(rows.column("id"))
                    vectors.append(matrix(rows.column("vector")))
                    continue
                if not ids:
                    continue
                if known is None:
                    known, held = pa.chunked_array(ids).combine_chunks(), np.concatenate(vectors)
                    vectors = [held]
                lists = rows.column("pairs")
                pairs = lists.flatten()
                asked = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                at = pc.index_in(pairs.field(RIGHT), value_set=known)
                there = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                at = at.fill_null(0).to_numpy()
                mine = matrix(rows.column("vector"))
                for first in range(0, len(there), PAIR_ROWS):
                    some = there[first : first + PAIR_ROWS]
                    chosen = pairs.take(pa.array(some))
                    columns = [rows.column("id").take(pa.array(asked[some])), *[chosen.field(name) for name in (RIGHT, *kept)]]
                    yield pa.RecordBatch.from_arrays([*columns, entries(mine[asked[some]] * vectors[0][at[some]])], [LEFT, RIGHT, *kept, ENTRIES])

    return run


def pair_products(
    pairs: DataFrame, vectors: DataFrame, left: str, right: str, name: str, cuts: Sequence[Sequence[float]] | None = None, **hot_limits
) -> DataFrame:
    """`pairs` with `name`, the elementwise product of the vectors (`id`, `embedding`) of both ends.

    With `cuts`, ascending numbers for each entry, how many of them lie below an entry, a byte each.  The
    second ends are dealt into parts; the vector of a first end goes once to every part
    it has a pair in, with the list of these pairs, so no pair carries a vector.  Pairs of a hub
    are spread over all parts, where its vector goes too.  Pairs with an end that has no vector are left out.
    """
    spark, kept = pairs.sparkSession, [c for c in pairs.columns if c not in (left, right)]
    parts = max(spark.sparkContext.defaultParallelism, -(-vectors.count() // PART_VERTICES), 1)
    by_left, by_right = HotKeys.find(pairs, left, **hot_limits), HotKeys.find(pairs, right, **hot_limits)
    many = lambda hot, end: F.col(end).isin(list(hot.values)) if hot.values else F.lit(False)
    part_of = lambda end: F.pmod(F.xxhash64(end), F.lit(parts)).cast("int")
    part = F.when(many(by_right, right), part_of(left)).otherwise(part_of(right))
    piece = F.when(many(by_left, left), F.pmod(F.xxhash64(right, F.lit(1)), F.lit(by_left.fanout))).otherwise(F.lit(0))
    entry = F.struct(F.col(right).alias(RIGHT), *kept)
    lists = pairs.groupBy(left, part.alias("part"), piece.alias("piece")).agg(F.collect_list(entry).alias("pairs"))
    asked = lists.join(vectors.withColumnRenamed("id", left), left).select(
        "part", F.lit(ASKED).alias("role"), F.col(left).alias("id"), F.col("embedding").alias("vector"), "pairs"
    )
    met = pairs.select(right).distinct().join(vectors.withColumnRenamed("id", right), right)
    places = F.when(many(by_right, right), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(part_of(right)))
    held = met.select(
        F.explode(places).alias("part"), F.lit(HELD).alias("role"), F.col(right).alias("id"), F.col("embedding").alias("vector"),
        F.lit(None).cast(dict(lists.dtypes)["pairs"]).alias("pairs"),
    )
    dealt = held.unionByName(asked).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "role")
    kinds = dict(pairs.dtypes)
    columns = [(LEFT, kinds[left]), (RIGHT, kinds[right]), *[(c, kinds[c]) for c in kept]]
    schema = ", ".join(f"`{c}` {kind}" for c, kind in columns) + f", {ENTRIES} array<{'double' if cuts is None else 'tinyint'}>"
    return dealt.mapInArrow(_products(kept, cuts), schema).withColumnsRenamed({LEFT: left, RIGHT: right, ENTRIES: name})


def hadamard(left: Column | str, right: Column | str) -> Column:
    """Elementwise product of two vectors."""
    return F.zip_with(left, right, lambda a, b: a * b)
