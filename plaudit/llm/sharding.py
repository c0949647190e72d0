"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Rows with equal texts form a group.  A group over 1/`units` of all bytes, tokens or rows is
placed by itself, and cut by row hash into chunks if it exceeds an eighth of a shard; smaller groups
are pooled by hash into `units` pools.  So the driver packs a number of units that is bounded
whatever the corpus holds, largest first, each into the shard whose residual capacity has the
highest dot product with the unit's needs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from plaudit.llm.mixing import word_count
from plaudit.session import cut_lineage

DIMENSIONS = ("bytes", "tokens", "rows")
SLOT_ROWS = 20_000


@dataclass(frozen=True)
class Sharding:
    """shards: how many.  units: pools of small groups, at most as many large groups per dimension.
    chunk: largest share of one shard that a piece of a group may take.
    """

    shards: int = 24
    units: int = 4096
    chunk: float = 0.125


def pack(needs: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit, given the (units, dimensions) shares of all bytes, tokens and rows it needs.

    Ties go to the unit with the smaller index and the shard with the smaller number.
    """
    residual = np.full((shards, needs.shape[1]), 1.0 / shards)
    placed = np.zeros(len(needs), np.int64)
    for unit in np.argsort(-(needs**2).sum(axis=1), kind="stable"):
        placed[unit] = shard = int(np.argmax(residual @ needs[unit]))
        residual[shard] -= needs[unit]
    return placed


def shard(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", how: Sharding = Sharding()) -> DataFrame:
    """Per row: id, `size` (UTF-8 bytes plus 8), `text_crc32`, `shard` and `slot`, gapless from 0 in every shard.

    Null texts count as empty.  Repeated rows belong to one group and get a slot each.  No
    rows give no shards.  Other columns are not carried along and may have any name.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    bytes_ = F.octet_length(text).cast("long")
    rows = cut_lineage(
        docs.select(
            F.col(f"`{id_column}`").alias("id"),
            (bytes_ + 8).alias("bytes"),
            word_count(text).alias("tokens"),
            F.lit(1).cast("long").alias("rows"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
        ),
        "sized",
    )
    total = rows.agg(*[F.sum(d).alias(d) for d in DIMENSIONS]).first()
    sums = [F.sum(d).alias(d) for d in DIMENSIONS]
    key = ["text_hash", "text_crc32"]
    groups = cut_lineage(rows.groupBy(*key).agg(*sums), "groups")
    share = F.greatest(*[F.col(d) / max(total[d] or 0, 1) for d in DIMENSIONS])
    large = groups.filter(share * how.units > 1)
    chunks = F.ceil(share * how.shards / how.chunk).cast("int")
    pool = F.pmod(F.xxhash64(*key), F.lit(how.units)).cast("int")
    # At most `units` groups per dimension can be large, so this table has a bound for broadcasting.
    named = large.select(*key, chunks.alias("chunks"), F.xxhash64(*key, F.lit("large")).alias("large"))
    piece = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit("piece")), F.col("chunks")).cast("int")
    unit = F.when(F.col("large").isNull(), F.struct(pool.cast("long").alias("of"), F.lit(-1).alias("piece"))).otherwise(
        F.struct(F.col("large").alias("of"), piece.alias("piece"))
    )
    units_of = cut_lineage(rows.join(F.broadcast(named), key, "left").withColumn("unit", unit).drop("large", "chunks", "text_hash"), "units")
    listed = units_of.groupBy("unit").agg(*sums).orderBy("unit").collect()
    needs = np.array([[r[d] / max(total[d] or 0, 1) for d in DIMENSIONS] for r in listed]).reshape(-1, len(DIMENSIONS))
    placed = pack(needs, how.shards)
    spark = docs.sparkSession
    shards = spark.createDataFrame(
        [(r["unit"]["of"], r["unit"]["piece"], int(s)) for r, s in zip(listed, placed)], "of long, piece int, shard int"
    ).select(F.struct("of", "piece").alias("unit"), "shard")
    with_shard = units_of.join(F.broadcast(shards), "unit").drop("unit")

    # A shard may hold very many rows: they are numbered range by range of a row hash.
    ranges = max(1, -(-(total["rows"] or 0) // (how.shards * SLOT_ROWS)))
    ranged = with_shard.withColumn("range", F.pmod(F.xxhash64(F.lit("slot"), "id"), F.lit(ranges)).cast("int"))
    lower = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "range", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("shard", "range").orderBy("id", "text_crc32", "bytes")
    return ranged.withColumn("row", F.row_number().over(inside)).join(offsets, ["shard", "range"]).select(
        F.col("id").alias(id_column),
        F.col("bytes").alias("size"),
        "text_crc32",
        "shard",
        (F.col("offset") + F.col("row") - 1).cast("long").alias("slot"),
    )
