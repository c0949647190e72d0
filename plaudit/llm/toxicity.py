"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of a hashed n-gram in a text.  Its ratio r compares how often toxic
and other training texts have it; a logistic regression is trained on r times presence.  At most
`fit_rows` labelled rows, chosen by hash, form the training sample; this documented bound also
limits what the driver sees.  Scoring covers whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plaudit.llm.words import free_name, mix, powers, releasing
from plaudit.operators.sampling import sample_rows
from plaudit.session import cut_lineage

BITS = 20
# Texts whose letters are hashed at once, rows whose texts are held at once, rows of a batch handed back:
# two workers stand beside a JVM, and results do not depend on these.
CHUNK_LETTERS = 1 << 17
CHUNK_ROWS = 512
OUT_ROWS = 1 << 16
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 2**64)


@dataclass(frozen=True)
class Training:
    """orders: n-gram lengths.  fit_rows: most labelled rows used, chosen by hash.
    features: most features kept.  support: fewest training texts with a feature.
    ridge: weight of the squared coefficients.  rounds: gradient steps.
    """

    orders: tuple[int, ...] = (4, 5, 6)
    fit_rows: int = 30_000
    features: int = 4096
    support: int = 5
    ridge: float = 1e-5
    rounds: int = 500
    seed: int = 11


@dataclass(frozen=True)
class ToxicityModel:
    """Slots with their weights (coefficient times ratio) and the intercept."""

    orders: tuple[int, ...]
    slots: np.ndarray
    weights: np.ndarray
    intercept: float


def present(texts: list[str], orders: tuple[int, ...], wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, text index, slot) of the distinct n-gram slots of each text, some texts at a time.

    `wanted` marks the slots of interest.  Case is folded, blanks are letters like any other.
    """
    first = 0
    while first < len(texts):
        taken, letters = [], 0
        while first + len(taken) < len(texts) and (not taken or letters + len(texts[first + len(taken)]) <= CHUNK_LETTERS):
            # A blank on either side lets an n-gram mark the start of a text like that of a word.
            taken.append(" " + texts[first + len(taken)].lower() + " ")
            letters += len(taken[-1])
        codes = np.frombuffer("\0".join(taken).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(t) for t in taken])
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        owner = np.repeat(np.arange(len(taken), dtype=np.int64), np.append(lengths[:-1] + 1, lengths[-1]))
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(codes)), out=total[1:])
        found = []
        for n in orders:
            here = len(codes) - n + 1
            if here <= 0:
                continue
            slots = ((total[n:] - total[:here]) * powers(_BASE_INVERSE, here)) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)
            slots = (slots >> np.uint64(64 - BITS)).astype(np.int64)
            inside = np.ones(here, bool)
            for cut in starts[1:]:
                inside[max(cut - n, 0) : min(cut, here)] = False
            if wanted is not None:
                inside &= wanted[slots]
            at = np.flatnonzero(inside)
            found.append((owner[at] << BITS) | slots[at])
        both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        yield first, both >> BITS, both & ((1 << BITS) - 1)
        first += len(taken)


def _some_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(first row, rows) of a batch in parts of `CHUNK_ROWS`."""
    for first in range(0, batch.num_rows, CHUNK_ROWS):
        yield first, batch.slice(first, CHUNK_ROWS)


def held_out(doc_id) -> F.Column:
    """True for the rows of the fixed test fold: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _counts(rows: DataFrame, orders: tuple[int, ...]) -> DataFrame:
    """Training texts of either label that have a slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for _, rows in _some_rows(batch):
                label = np.array(rows.column(1).to_pylist(), np.int64)
                for first, text, slot in present([t or "" for t in rows.column(0).to_pylist()], orders):
                    np.add.at(counts, (label[first + text], slot), 1)
        slots = np.flatnonzero(counts.any(axis=0))
        for i in range(0, len(slots), OUT_ROWS):
            part = slots[i : i + OUT_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[0, part]), pa.array(counts[1, part])], ["slot", "others", "toxic"])

    partial = rows.select("text", "label").mapInArrow(releasing(run), "slot bigint, others bigint, toxic bigint")
    return partial.groupBy("slot").agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic"))


def _features(rows: DataFrame, orders: tuple[int, ...], slots: np.ndarray) -> DataFrame:
    wanted = np.zeros(1 << BITS, bool)
    wanted[slots] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (part for batch in batches for _, part in _some_rows(batch)):
            lists: list[np.ndarray] = [np.zeros(0, np.int64)] * some.num_rows
            for first, text, slot in present([t or "" for t in some.column(0).to_pylist()], orders, wanted):
                cuts = np.searchsorted(text, np.arange(text.max() + 2)) if len(text) else [0]
                for i in range(len(cuts) - 1):
                    lists[first + i] = slot[cuts[i] : cuts[i + 1]]
            yield pa.RecordBatch.from_arrays([some.column(1), pa.array(lists, pa.list_(pa.int64()))], ["label", "slots"])

    return rows.select("text", "label").mapInArrow(releasing(run), "label int, slots array<bigint>")


def _logistic(rows: list, slots: np.ndarray, ratios: np.ndarray, how: Training) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent on the logistic loss of ratio-scaled presences."""
    label = np.array([r["label"] for r in rows], float)
    column = np.searchsorted(slots, np.array([s for r in rows for s in r["slots"]], np.int64))
    owner = np.repeat(np.arange(len(rows)), [len(r["slots"]) for r in rows])
    value = ratios[column]
    # Few texts are toxic; both sides weigh the same.
    weight = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    reach = np.bincount(owner, value**2, len(rows)).max(initial=1.0)
    step = 4.0 / (reach + 1.0)
    w, b, v, c = np.zeros(len(slots)), 0.0, np.zeros(len(slots)), 0.0
    for i in range(how.rounds):
        margin = np.bincount(owner, value * v[column], len(rows)) + c
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - label)
        new_w = v - step * (np.bincount(column, value * error[owner], len(slots)) + how.ridge * v)
        new_b = c - step * error.sum()
        pull = i / (i + 3)
        v, c = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    return w, b


def train(labelled: DataFrame, how: Training = Training()) -> ToxicityModel:
    """Fit on the rows of `text` and `label` (0 or 1; other labels and null are left out).

    With no rows of one label the model scores every text 0.5.
    """
    return _fit(cut_lineage(_sample(labelled, how), "labelled"), how)


def _sample(labelled: DataFrame, how: Training) -> DataFrame:
    rows = labelled.filter(F.col("label").isin(0, 1)).select("text", F.col("label").cast("int").alias("label"))
    rows = rows.withColumn("digest", F.xxhash64(F.coalesce("text", F.lit(""))))
    return sample_rows(rows, ["digest"], how.fit_rows, how.seed).select("text", "label")


def _fit(rows: DataFrame, how: Training) -> ToxicityModel:
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    others, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not others or not toxic:
        return ToxicityModel(how.orders, np.zeros(0, np.int64), np.zeros(0), 0.0)
    ratio = F.log((F.col("toxic") + 1) / (toxic + 2.0)) - F.log((F.col("others") + 1) / (others + 2.0))
    kept = (
        _counts(rows, how.orders)
        .filter(F.col("toxic") + F.col("others") >= how.support)
        .select("slot", ratio.alias("ratio"), (F.abs(ratio) * F.greatest("toxic", "others")).alias("use"),
                ((F.col("toxic") / toxic - F.col("others") / others) * ratio).alias("gain"))
        .orderBy(F.desc("gain"), "slot")
        .limit(how.features)
        .collect()
    )
    kept.sort(key=lambda r: r["slot"])
    slots, ratios = np.array([r["slot"] for r in kept], np.int64), np.array([r["ratio"] for r in kept])
    w, b = _logistic(_features(rows, how.orders, slots).collect(), slots, ratios, how)
    return ToxicityModel(how.orders, slots, w * ratios, b)


@lru_cache(maxsize=2)
def _table(slots: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    table = np.zeros(1 << BITS)
    table[np.frombuffer(slots, np.int64)] = np.frombuffer(weights)
    return table, table != 0


def score(docs: DataFrame, model: ToxicityModel, text_column: str = "text", name: str = "score") -> DataFrame:
    """`docs` with the probability-like score of each whole text; null and empty texts get that of no features.

    Every row keeps its columns; a column called like the score is replaced.
    """
    kept = [c for c in docs.columns if c != name]
    given = free_name(kept, "given")
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_column}`").cast("string").alias(given))
    schema = source.drop(given).schema.add(name, "double")
    slots, weights = model.slots.tobytes(), model.weights.astype(float).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, wanted = _table(slots, weights)
        for batch in batches:
            margin = np.full(batch.num_rows, model.intercept)
            for at, rows in _some_rows(batch):
                texts = [t or "" for t in rows.column(rows.num_columns - 1).to_pylist()]
                for first, text, slot in present(texts, model.orders, wanted):
                    np.add.at(margin, at + first + text, table[slot])
            scores = 1 / (1 + np.exp(-np.clip(margin, -60, 60)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*kept, name])

    return source.mapInArrow(releasing(run), schema)


def train_on_labels(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> ToxicityModel:
    """Join `labels.toxic` to the texts and fit on rows outside the test fold.

    The sample of `fit_rows` labels is chosen before the join, so only its texts are written and
    no text is shuffled.  Labels without a text, of another value or with a null id are not used.
    """
    known = labels.select("doc_id", F.col("toxic").alias("label")).filter(
        ~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
    )
    known = cut_lineage(sample_rows(known, ["doc_id"], how.fit_rows, how.seed), "known")
    # At most fit_rows rows of an id and a label: small enough for every task.
    rows = cut_lineage(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "label"), "labelled")
    # Documents that repeat an id could exceed the bound.
    return _fit(_sample(rows, how), how)
