"""The named queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.llm import alignment, bpe, fingerprints, lexical, mixing, near_dedup, neighbours, pii, quality, sharding, toxicity, vector_dedup, warc
from plaudit.session import cut_lineage, new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op6_mixing": mixing.MIX_SQL, "op12_vector_dedup": vector_dedup.LINKS_SQL, "op13_lexical_search": lexical.SEARCH_SQL}
# Session option that holds the key of pseudonyms.
PSEUDONYM_KEY = "spark.plaudit.pseudonymKey"
TOXIC_FROM = 0.7
GOOD_FROM = 0.5


def _query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pseudonym_key(spark: SparkSession) -> str:
    """The key named by the session; without one, a random key that lasts as long as the session."""
    if spark.conf.get(PSEUDONYM_KEY, None) is None:
        spark.conf.set(PSEUDONYM_KEY, secrets.token_hex(32))
    return spark.conf.get(PSEUDONYM_KEY)


@_query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return bpe.round_trip(_table(spark, folder, "documents").select("doc_id", "text"), vocabulary_path())


@_query
def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprints.fingerprints(_table(spark, folder, "documents"))


@_query
def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share 85 % of their three-word shingles."""
    return near_dedup.near_duplicates(
        _table(spark, folder, "documents"), plan=near_dedup.NearDedup(words=3, percent=85)
    )


@_query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document, the bytes of the shards near equal."""
    return sharding.shard(_table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@_query
def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    return neighbours.nearest(_table(spark, folder, "embeddings"), lambda vec_id: vec_id % 20 == 0)


@_query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of all sources takes from each document."""
    return mixing.mix(_table(spark, folder, "documents")).drop("source")


@_query
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    """All texts with pseudonyms for personal data and the number of values replaced."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pseudonym_key(spark), count_column="n_replaced")


@_query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document from its text, its source and its language within the source."""
    scored = quality.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"), toxicity.held_out)
    return scored.withColumn("held_out", toxicity.held_out("doc_id")).withColumn("keep", F.col("score") >= GOOD_FROM)


@_query
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to archives and read back."""
    path = new_path(spark, "warc")
    warc.write_warc(_table(spark, folder, "pages"), path)
    # Two branches use the records; they are parsed once.
    records = warc.read_warc(spark, path)
    return warc.pages_of(cut_lineage(warc.lengths_of(records), "records"))


@_query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document by a model that has not seen the test fold."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train_on_labels(docs, _table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).cast("int").alias("predicted"),
    )


@_query
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of a byte-level and a sentence-piece vocabulary fit on every document."""
    return alignment.alignment(_table(spark, folder, "documents"), vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))


@_query
def op12_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links, components and representatives of vectors of one label with a cosine of at least 0.98."""
    return vector_dedup.near_duplicate_vectors(_table(spark, folder, "embeddings"))


@_query
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 documents that score highest for every benchmark item."""
    return lexical.search(lexical.build_index(_table(spark, folder, "documents")), _table(spark, folder, "benchmark"))
