"""Near duplicates: MinHash bands, sequential Bayesian verification, exact confirmation.

1. Texts with equal shingle sets form a class; only classes are compared.
2. Classes that agree in all rows of a band share a bucket.  First every member is compared
   with one anchor of the bucket, which joins large groups of copies with as many pairs as
   members.  Then buckets that still hold several components compare the members of
   different components inside one task, which gives out one link per two components.
3. Signatures are compared in batches.  After n hashes with m agreements the posterior of the
   similarity under a uniform prior is Beta(m + 1, n - m + 1); a pair leaves as soon as its
   probability of reaching the threshold is below `miss`.
4. Survivors are confirmed on their full shingle sets.

Buckets beyond `block` members are compared pair of blocks by pair of blocks, so that all their members
meet whatever their number; the work on such a bucket grows with the square of its size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plaudit.llm.components import components
from plaudit.llm.words import give_back, releasing, shingle_sets, text_chunks
from plaudit.session import cut_lineage

SIGNED = "id {id}, n_shingles bigint, class binary, signature binary"


@dataclass(frozen=True)
class NearDedup:
    """Parameters; the number of bands follows from the threshold.

    words: words per shingle.  percent: similarity in per cent from which texts are linked.
    rows: hashes per band.  unseen: chance that a pair at the threshold shares no band.
    miss: posterior probability below which a pair is given up.  batch: hashes compared at
    once.  block: most members of a bucket that one task compares.  least_hashes: length of
    the signature at least; more hashes than the bands need sharpen the posterior.
    """

    words: int = 5
    percent: int = 80
    rows: int = 6
    unseen: float = 1e-5
    miss: float = 1e-6
    batch: int = 32
    block: int = 1000
    least_hashes: int = 256
    seed: int = 7

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.unseen) / math.log1p(-((self.percent / 100) ** self.rows)))

    @property
    def hashes(self) -> int:
        return max(self.bands * self.rows, self.least_hashes)

    def steps(self) -> list[tuple[int, int, int]]:
        """(first hash, end, agreements needed so far) of each batch."""
        ends = list(range(self.batch, self.hashes, self.batch)) + [self.hashes]
        return list(zip([0, *ends[:-1]], ends, (least_agreements(n, self.percent / 100, self.miss) for n in ends)))


@lru_cache
def least_agreements(n: int, threshold: float, miss: float) -> int:
    """Fewest agreements of n for which P(similarity >= threshold) is at least `miss`.

    The upper tail of Beta(m + 1, n - m + 1) is the chance of at most m successes in n + 1 draws.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


@lru_cache
def _hash_functions(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(seed))
    factors = random.integers(0, 2**32, (count, 1), dtype=np.uint32) | np.uint32(1)
    return factors, random.integers(0, 2**32, (count, 1), dtype=np.uint32)


def minhash(shingles: np.ndarray, count: int, seed: int) -> np.ndarray:
    factors, shifts = _hash_functions(count, seed)
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    lowest = np.full(count, 2**32 - 1, np.uint32)
    for i in range(0, len(values), 1024):
        lowest = np.minimum(lowest, (factors * values[None, i : i + 1024] + shifts).min(axis=1))
    return lowest


def _class_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, id_column: str, text_column: str, plan: NearDedup) -> DataFrame:
    """id, number of distinct shingles, class and signature of every row (the latter null without words)."""
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, data, offsets in text_chunks(batch.column(1)):
                sizes, classes, signed = [], [], []
                for shingles in shingle_sets(data, offsets, plan.words):
                    sizes.append(len(shingles))
                    full = len(shingles) > 0
                    classes.append(_class_of(shingles) if full else None)
                    signed.append(minhash(shingles, plan.hashes, plan.seed).tobytes() if full else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(sizes, pa.int64()),
                     pa.array(classes, pa.binary()), pa.array(signed, pa.binary())],
                    ["id", "n_shingles", "class", "signature"],
                )

    return chosen.mapInArrow(releasing(run), SIGNED.format(id=dict(chosen.dtypes)["id"]))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, width)


def band_keys(nodes: DataFrame, plan: NearDedup) -> DataFrame:
    """`bucket`, `node` for every band of every node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = _bucket_numbers(_matrix(batch.column(1), plan.hashes), plan)
            nodes_of = np.repeat(np.arange(batch.num_rows), plan.bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), batch.column(0).take(pa.array(nodes_of))], ["bucket", "node"]
            )

    return nodes.select("node", "signature").mapInArrow(releasing(run), "bucket bigint, node binary")


def _bucket_numbers(signed: np.ndarray, plan: NearDedup) -> np.ndarray:
    """(rows, bands) numbers that agree where all hashes of the band agree."""
    from plaudit.llm.words import mix, powers

    rows = signed[:, : plan.bands * plan.rows].reshape(len(signed), plan.bands, plan.rows).astype(np.uint64) + np.uint64(1)
    total = (rows * powers(0xD6E8FEB86659FD93, plan.rows + 1)[1:]).sum(axis=2, dtype=np.uint64)
    return mix(total + np.arange(1, plan.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _promising(pairs: DataFrame, nodes: DataFrame, plan: NearDedup) -> DataFrame:
    """The pairs `a`, `b` that no batch of their signatures rules out."""
    signed = nodes.select("node", "signature")
    left = signed.toDF("a", "signature_a")
    right = signed.toDF("b", "signature_b")
    steps = plan.steps()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, y = _matrix(batch.column(2), plan.hashes), _matrix(batch.column(3), plan.hashes)
            alive, agreed = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int32)
            for begin, end, needed in steps:
                agreed = agreed + (x[alive, begin:end] == y[alive, begin:end]).sum(axis=1)
                alive, agreed = alive[agreed >= needed], agreed[agreed >= needed]
            kept = pa.array(alive)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], ["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "signature_a", "signature_b")
    return joined.mapInArrow(releasing(run), "a binary, b binary")


def _links_across(table: pa.Table, plan: NearDedup) -> pa.Table:
    """Links between different components within one bucket, one for each two that meet.

    Signatures rule out most pairs; the others are confirmed on full sets right here, so
    that pairs which are similar but not enough never leave the task.
    """
    node, signed = table.column("node").to_pylist(), _matrix(table.column("signature"), plan.hashes)
    _, root = np.unique(np.array(table.column("root").to_pylist(), object), return_inverse=True)
    part = np.array(table.column("part").to_pylist())
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    size = np.array([len(s) for s in sets])
    begin_of = np.concatenate([[0], np.cumsum(size)[:-1]])
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    steps = plan.steps()
    found_a, found_b = [], []
    for i in range(len(node) - 1):
        # Blocks 0 and 1 of one task are compared with each other, a lone block with itself.
        apart = root[i + 1 :] != root[i]
        if part.max() > 0:
            apart &= part[i + 1 :] != part[i]
        others = i + 1 + np.flatnonzero(apart)
        agreed = np.zeros(len(others), np.int32)
        for begin, end, needed in steps:
            if not len(others):
                break
            agreed = agreed + (signed[i, begin:end] == signed[others, begin:end]).sum(axis=1, dtype=np.int32)
            alive = agreed >= needed
            others, agreed = others[alive], agreed[alive]
        if not len(others):
            continue
        mine = np.zeros(int(number.max()) + 1, np.int64)
        mine[number[begin_of[i] : begin_of[i] + size[i]]] = 1
        common = np.add.reduceat(mine[number], begin_of)[others]
        for j in others[100 * common >= plan.percent * (size[i] + size[others] - common)]:
            if root[i] != root[j]:
                found_a.append(min(node[i], node[j]))
                found_b.append(max(node[i], node[j]))
                root[root == root[j]] = root[i]
    return pa.table({"a": pa.array(found_a, pa.binary()), "b": pa.array(found_b, pa.binary())})


def _shingles(wanted: DataFrame, docs: DataFrame, id_column: str, text_column: str, reps: DataFrame, plan: NearDedup) -> DataFrame:
    """`node`, `shingles`: the full sets of the nodes in `wanted`, made anew from their texts."""
    wanted = cut_lineage(wanted.join(reps, "node"), "wanted")
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).join(
        wanted.select(F.col("id").alias("rep")).distinct(), F.col("id").eqNullSafe(F.col("rep")), "left_semi"
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                full = [s for s in shingle_sets(data, offsets, plan.words) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_class_of(s) for s in full], pa.binary()),
                     pa.array([s.tobytes() for s in full], pa.binary())],
                    ["node", "shingles"],
                )

    found = texts.select("text").mapInArrow(releasing(sets), "node binary, shingles binary")
    # Several rows may carry the number of a representative; one of each class is enough.
    return cut_lineage(found.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "shingles")


def _confirmed(pairs: DataFrame, found: DataFrame, plan: NearDedup) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                if 100 * common >= plan.percent * (len(x) + len(y) - common):
                    kept.append(i)
            kept = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], ["a", "b"])

    joined = pairs.join(found.toDF("a", "x"), "a").join(found.toDF("b", "y"), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(releasing(compare), "a binary, b binary")


def _split_large(members: DataFrame, plan: NearDedup) -> DataFrame:
    """Members of buckets no larger than a block, with `part` 0, or 1 for the second block of a pair.

    A larger bucket is cut into blocks by hash, and each pair of blocks is a bucket, whatever its size.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    members = cut_lineage(members.join(sizes, "bucket"), "members")
    small = members.filter(F.col("members") <= plan.block).select("bucket", "node", F.lit(0).alias("part"))
    blocks = F.ceil(2 * F.col("members") / plan.block).cast("int")
    pairs = members.filter(F.col("members") > plan.block).withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).select(
        "bucket", "node", "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    )
    return small.unionByName(
        pairs.select(
            F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"),
            "node",
            (F.col("own") > F.col("other")).cast("int").alias("part"),
        )
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", plan: NearDedup = NearDedup()) -> DataFrame:
    """One row per input row: its id, `n_shingles`, `component_id`, the smallest id reachable, and `kept`.

    A null, empty or blank text has no shingles and is linked with nothing.  Repeated rows
    form one class.  A null id counts as larger than all others, so it names a component
    only if there is no other.  Other columns are not carried along and may have any name.
    """
    members = cut_lineage(signatures(docs, id_column, text_column, plan), "signed")
    nodes = cut_lineage(
        members.filter(F.col("class").isNotNull()).groupBy(F.col("class").alias("node"))
        .agg(F.min("id").alias("id"), F.first("signature").alias("signature")),
        "nodes",
    )
    reps = nodes.select("node", "id")

    keyed = band_keys(nodes, plan)
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("anchor"))
    buckets = cut_lineage(keyed.join(shared.filter("members > 1"), "bucket"), "buckets")
    to_anchor = buckets.filter("node != anchor").select(
        F.least("node", "anchor").alias("a"), F.greatest("node", "anchor").alias("b")
    )
    tried = cut_lineage(_promising(to_anchor.distinct(), nodes, plan), "pairs")
    ends = tried.select(F.col("a").alias("node")).unionByName(tried.select(F.col("b").alias("node"))).distinct()
    found = _shingles(ends, docs, id_column, text_column, reps, plan)
    links = cut_lineage(_confirmed(tried, found, plan), "links")
    roots = cut_lineage(components(links), "roots")

    placed = buckets.filter("members > 2").join(roots, "node", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("root")
    )
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    open_buckets = cut_lineage(placed.join(mixed, "bucket", "left_semi"), "open")
    root_of = open_buckets.select("node", "root").distinct()
    found = _shingles(root_of.select("node"), docs, id_column, text_column, reps, plan)
    members_of = cut_lineage(nodes.select("node", "signature").join(found, "node").join(root_of, "node"), "members")
    split = _split_large(open_buckets.select("bucket", "node"), plan)

    def across(table: pa.Table) -> pa.Table:
        links = _links_across(table, plan)
        if table.num_rows > plan.block // 2:
            give_back()
        return links

    more = split.join(members_of, "node").groupBy("bucket").applyInArrow(across, "a binary, b binary")
    more = cut_lineage(more.distinct(), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        roots = cut_lineage(components(links), "roots")

    # Everything below is narrow: one row per document, no texts and no signatures.
    known = members.select("id", "n_shingles", F.col("class").alias("node"))
    first = reps.join(roots, "node").groupBy("root").agg(F.min("id").alias("component_id"))
    named = (
        reps.join(roots, "node", "left").join(first, "root", "left")
        .select("node", F.coalesce("component_id", "id").alias("component_id"))
    )
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return known.join(named, "node", "left").select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
