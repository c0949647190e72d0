"""From raw documents to token ids: filter, deduplicate, pseudonymise, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.llm import bpe, mixing, near_dedup, pii, toxicity
from plaudit.llm.queries import TOXIC_FROM, pseudonym_key, vocabulary_path
from plaudit.session import cut_lineage, new_path, remove_path, temporary_tables

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# No single SQL statement can train the classifier, confirm shingle sets or merge tokens;
# tests compare the stages with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the classifier, trained on the labelled documents, does not reject."""
    model = toxicity.train_on_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, name="__score").filter(F.col("__score") < TOXIC_FROM).select(*COLUMNS)


def _row(docs: DataFrame) -> DataFrame:
    """`docs` with `__row`, which orders rows by id (null last) and 128 bits of their contents; equal rows share it."""
    contents = [F.xxhash64(F.lit(i), *COLUMNS).alias(f"contents{i}") for i in range(2)]
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), *contents)
    return docs.select(*COLUMNS, key.alias("__row"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first row of each group that shares 80 % of its five-word shingles, whatever the ids.

    Rows are told apart by their id and contents, so none is copied to number it; of rows equal in
    all columns one stays.
    """
    rows = _row(docs)
    found = near_dedup.near_duplicates(rows, "__row")
    kept = cut_lineage(found.filter("kept").groupBy("__row").agg(F.count(F.lit(1)).alias("copies")), "kept")
    single = rows.join(kept.filter("copies = 1"), "__row", "left_semi")
    if kept.filter("copies > 1").isEmpty():
        return single.select(*COLUMNS)
    repeated = rows.join(kept.filter("copies > 1"), "__row", "left_semi").dropDuplicates(["__row"])
    return single.unionByName(repeated).select(*COLUMNS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms of the same format."""
    fresh = pii.pseudonymise(docs.select(*COLUMNS), pseudonym_key(spark))
    return fresh.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents for each whole epoch they are taken, and cut the last one of a source at its budget.

    Every row is decided where it lies: it meets one row per source, and no text is moved.
    """
    docs = docs.select(*COLUMNS)
    place, key = mixing.place_of(F.col("source")), mixing.row_key(COLUMNS)
    sized = docs.withColumn("place", place).withColumn("size", mixing.word_count(F.col("text"))).withColumn("key", key)
    rows = sized.join(mixing.cuts(docs), "place").withColumn("taken", mixing.taken_of(F.col("size"), F.col("key")))
    rows = rows.filter("taken > 0")
    # One entry per copy: the number of words it keeps.
    whole = F.array_repeat(F.col("size"), F.floor(F.col("taken") / F.col("size")).cast("int"))
    rest = F.when(F.col("taken") % F.col("size") > 0, F.array(F.col("taken") % F.col("size"))).otherwise(F.array().cast("array<bigint>"))
    copies = rows.withColumn("words", F.explode(F.concat(whole, rest)))
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(cut)
    return copies.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and proof that they decode to it."""
    encoded = bpe.encode(docs.select("doc_id", "text", "source"), vocabulary_path(), decoded_column="decoded")
    return encoded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written before the next one reads it.

    Tables that a stage needed meanwhile go when its output is written, and its input with them.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with temporary_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
