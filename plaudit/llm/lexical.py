"""Ranked lexical search by Block-Max MaxScore over a sharded index.

The index cuts the documents into shards of some megabytes of text.  In a shard, each term has a
list of postings in blocks: gaps between documents and term frequencies, each packed in as few
bytes as the block allows, the last document of every block, and the block's front, its pairs
of frequency and document length that no other pair beats.  The best score a block can give
follows from its front alone, whatever the corpus turns out to be.

A search orders the lists of an item by their bounds.  Lists whose bounds together stay below
the 50th best score so far are non-essential: documents found only there cannot enter.  All
postings of the essential lists are added up, range by range of documents; what they give
together with the block maxima of the non-essential lists rejects most candidates before any
of those blocks is unpacked.  The best of every shard are merged.

Terms are known by a 64-bit hash.  Items are searched in blocks of a bounded number of terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from plaudit.llm.words import text_chunks, word_hashes
from plaudit.session import cut_lineage

# The bytes of the term pattern [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+.
_is_term = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
# All others become blanks, which separate words.
AS_WORDS = np.where(_is_term, np.arange(256), 0x20).astype(np.uint8)

SHARD_BYTES = 32 << 20
BLOCK = 128
ITEM_TERMS = 100_000
FIRST_RANGE = 256
HEAD = np.dtype([("last", "<i4"), ("front", "<u2"), ("gap", "u1"), ("tf", "u1")])
FRONT = np.dtype([("tf", "<u4"), ("n", "<u4")])
LIST = "heads binary, gaps binary, tfs binary, fronts binary"


def impact(tf, m):
    """What a term's weight is multiplied with; grows with tf, falls with m."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


@dataclass(frozen=True)
class Corpus:
    """Documents with terms, and their terms with repeats."""

    documents: int
    terms: int

    def m(self, n: np.ndarray) -> np.ndarray:
        return 100 - 50 + 50 * n.astype(np.int64) * self.documents // max(self.terms, 1)


def _pack(values: np.ndarray, block: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, width per block, first byte per block) of values in 1, 2 or 4 bytes, as their block needs."""
    largest = np.maximum.reduceat(values, starts)
    width = np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4))
    size = width * np.diff(np.r_[starts, len(values)])
    begin = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    at = begin[block] + (np.arange(len(values)) - starts[block]) * width[block]
    for w in (1, 2, 4):
        chosen = width[block] == w
        letters = values[chosen].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :w]
        out[at[chosen][:, None] + np.arange(w)] = letters
    return out, width, begin


def _binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    offsets = np.r_[starts, len(data)].astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


def packed_lists(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
    """(terms, documents per term, columns of LIST) of postings sorted by term and document; `n` by posting."""
    new_term = np.r_[True, term[1:] != term[:-1]]
    first = np.flatnonzero(new_term)
    of_term = np.cumsum(new_term) - 1
    within = np.arange(len(term)) - first[of_term]
    starts = np.flatnonzero(within % BLOCK == 0)
    block = np.cumsum(within % BLOCK == 0) - 1
    gaps = np.where(new_term, doc + 1, np.diff(doc, prepend=0))
    gap_bytes, gap_width, gap_begin = _pack(gaps, block, starts)
    tf_bytes, tf_width, tf_begin = _pack(tf, block, starts)
    # By length and falling frequency, a posting is on its block's front if its frequency is higher than all before.
    order = np.lexsort((-tf, n, block))
    level = tf[order].astype(np.int64) + block[order] * np.int64(1 << 32)
    highest = np.maximum.accumulate(level)
    on_front = order[np.r_[True, level[1:] > highest[:-1]]]
    fronts = np.zeros(len(on_front), FRONT)
    fronts["tf"], fronts["n"] = tf[on_front], n[on_front]
    front_count = np.bincount(block[on_front], minlength=len(starts))
    heads = np.zeros(len(starts), HEAD)
    heads["last"] = doc[np.r_[starts[1:], len(doc)] - 1]
    heads["front"], heads["gap"], heads["tf"] = front_count, gap_width, tf_width
    first_block = block[first]
    front_begin = (np.cumsum(front_count) - front_count)[first_block]
    columns = [
        _binary(heads.view(np.uint8), first_block * HEAD.itemsize), _binary(gap_bytes, gap_begin[first_block]),
        _binary(tf_bytes, tf_begin[first_block]), _binary(fronts.view(np.uint8), front_begin * FRONT.itemsize),
    ]
    return term[first], np.diff(np.r_[first, len(term)]), columns


class Postings:
    """The list of one term in one shard; blocks are unpacked when first needed."""

    def __init__(self, heads: bytes, gaps: bytes, tfs: bytes, fronts: bytes, lengths: np.ndarray, corpus: Corpus):
        head, front = np.frombuffer(heads, HEAD), np.frombuffer(fronts, FRONT)
        self.last, self.gaps, self.tfs = head["last"], gaps, tfs
        # Every block is full but the last one.
        self.widths = head["gap"].astype(int), head["tf"].astype(int)
        counts = head["front"].astype(int)
        best = impact(front["tf"].astype(np.int64), corpus.m(front["n"]))
        self.block_max = np.maximum.reduceat(best, np.cumsum(counts) - counts)
        self.most = int(self.block_max.max())
        self.starts = [np.cumsum(BLOCK * w) - BLOCK * w for w in self.widths]
        self.lengths, self.corpus, self.open = lengths, corpus, {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block."""
        if i not in self.open:
            values = []
            for data, width, start in zip((self.gaps, self.tfs), self.widths, self.starts):
                part = data[start[i] : start[i] + BLOCK * width[i]]
                values.append(np.frombuffer(part, f"<u{width[i]}").astype(np.int64))
            docs = np.cumsum(values[0]) + (self.last[i - 1] if i else -1)
            self.open[i] = docs, impact(values[1], self.corpus.m(self.lengths[docs]))
        return self.open[i]

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from `low` to before `high` and their impacts."""
        first, last = np.searchsorted(self.last, [low, high - 1])
        parts = [self.block(i) for i in range(first, min(last + 1, len(self.last)))]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, values = (np.concatenate(c) for c in zip(*parts))
        cut = slice(*np.searchsorted(docs, [low, high]))
        return docs[cut], values[cut]

    def blocks_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block that could hold each document, and its maximum (0 past the end)."""
        at = np.searchsorted(self.last, docs)
        inside = at < len(self.last)
        return at, np.where(inside, self.block_max[np.minimum(at, len(self.last) - 1)], 0)

    def look_up(self, docs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Impacts of ascending documents that fall into the blocks `at`."""
        found = np.zeros(len(docs), np.int64)
        for i in np.unique(at[at < len(self.last)]):
            here = slice(*np.searchsorted(at, [i, i + 1]))
            known, values = self.block(i)
            place = np.minimum(np.searchsorted(known, docs[here]), len(known) - 1)
            found[here] = np.where(known[place] == docs[here], values[place], 0)
        return found


def _best(scores: np.ndarray, docs: np.ndarray, order_of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    chosen = np.lexsort((order_of[docs], -scores))[:k]
    return scores[chosen], docs[chosen]


def max_score(lists: list[tuple[int, Postings]], documents: int, order_of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores above 0 and documents of the k best of a shard; equal scores by `order_of` the document."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].most)
    together = np.cumsum([w * p.most for w, p in lists])
    scores, docs, bar = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    low, size = 0, FIRST_RANGE
    while low < documents:
        high = min(low + size, documents)
        # Lists before this one cannot reach the bar even together.
        essential = int(np.searchsorted(together, bar))
        if essential == len(lists):
            break
        total = np.zeros(high - low, np.int64)
        for w, postings in lists[essential:]:
            some, values = postings.between(low, high)
            total[some - low] += w * values
        alive = np.flatnonzero(total)
        found, alive = total[alive], alive + low
        others = lists[:essential]
        blocks = [postings.blocks_of(alive) for _, postings in others]
        limits = [w * most for (w, _), (_, most) in zip(others, blocks)]
        rest = np.sum(limits, axis=0) if others else np.zeros(len(alive), np.int64)
        at = [place for place, _ in blocks]
        kept = np.arange(len(alive))
        for i in range(essential - 1, -2, -1):
            good = found + rest >= bar
            found, rest, kept = found[good], rest[good], kept[good]
            if i < 0 or not len(kept):
                break
            w, postings = others[i]
            found = found + w * postings.look_up(alive[kept], at[i][kept])
            rest = rest - limits[i][kept]
        scores, docs = _best(np.r_[scores, found], np.r_[docs, alive[kept]], order_of, k)
        if len(scores) == k:
            bar = max(1, int(scores[-1]))
        low, size = high, 2 * size
    return scores, docs


def _texts(table: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return table.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))


def _term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, text, frequency) of a chunk of texts, and the number of terms of each text."""
    terms, first = word_hashes(AS_WORDS[data], offsets)
    n = np.diff(first)
    known, at = np.unique(terms.view(np.int64), return_inverse=True)
    pairs, tf = np.unique(at * np.int64(len(n)) + np.repeat(np.arange(len(n)), n), return_counts=True)
    return known[pairs // len(n)], pairs % len(n), tf, n


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index, written once: per shard a row for each term, and one without a term that holds ids and lengths.

    A null text has no terms.  A text longer than a shard makes a shard of its own.
    """
    chosen = _texts(docs, id_column, text_column)
    kind = dict(chosen.dtypes)["id"]
    names = ["shard", "term", "df", "heads", "gaps", "tfs", "fronts", "ids", "lengths"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, shards, held, first = TaskContext.get().partitionId(), 0, 0, 0
        ids, lengths, parts = [], [], []

        def shard() -> Iterator[pa.RecordBatch]:
            number = (partition << 32) + shards
            n = np.concatenate(lengths)
            joined = pa.concat_arrays(ids)
            doc_table = pa.RecordBatch.from_arrays(
                [pa.array([number]), *[pa.nulls(1, t) for t in (pa.int64(), pa.int64(), *[pa.binary()] * 4)],
                 pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), joined), pa.array([n], pa.list_(pa.int64()))], names,
            )
            yield doc_table
            term, doc, tf = (np.concatenate(c) for c in zip(*parts))
            if len(term):
                # Every part is sorted by term and document, and parts ascend by document.
                order = np.argsort(term, kind="stable")
                doc = doc[order]
                terms, df, columns = packed_lists(term[order], doc, tf[order], n[doc])
                for at in range(0, len(terms), 10_000):
                    some = slice(at, min(at + 10_000, len(terms)))
                    size = some.stop - at
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(size, number)), pa.array(terms[some]), pa.array(df[some]),
                         *[c.slice(at, size) for c in columns], pa.nulls(size, doc_table.schema.field("ids").type), pa.nulls(size, pa.list_(pa.int64()))],
                        names,
                    )

        for batch in batches:
            for begin, rows, data, offsets in text_chunks(batch.column(1)):
                term, doc, tf, n = _term_counts(data, offsets)
                parts.append((term, doc + first, tf))
                lengths.append(n)
                ids.append(batch.column(0).slice(begin, rows))
                held, first = held + len(data), first + rows
                if held >= shard_bytes:
                    yield from shard()
                    shards, held, first, ids, lengths, parts = shards + 1, 0, 0, [], [], []
        if ids:
            yield from shard()

    schema = f"shard bigint, term bigint, df bigint, {LIST}, ids array<{kind}>, lengths array<bigint>"
    return cut_lineage(chosen.mapInArrow(run, schema), "index")


def _item_terms(items: DataFrame) -> DataFrame:
    """`item`, `term` of every different term of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, rows, data, offsets in text_chunks(batch.column(1)):
                term, text, _, _ = _term_counts(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(begin + text)), pa.array(term)], ["item", "term"])

    return items.select("item", "text").mapInArrow(run, "item bigint, term bigint")


def _searcher(questions, corpus: Corpus, nearest: int):
    def run(table: pa.Table) -> pa.Table:
        is_list = table.column("term").is_valid().to_numpy()
        docs = table.filter(pa.array(~is_list))
        table = table.filter(pa.array(is_list))
        ids = docs.column("ids").combine_chunks().flatten()
        lengths = docs.column("lengths").combine_chunks().flatten().to_numpy()
        order_of = np.empty(len(ids), np.int64)
        order_of[pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        packed = [table.column(c).to_pylist() for c in ("heads", "gaps", "tfs", "fronts")]
        lists = {t: Postings(*parts, lengths, corpus) for t, *parts in zip(table.column("term").to_pylist(), *packed)}
        out = [(np.zeros(0, np.int64),) * 3]
        for item, terms in questions.value:
            scores, found = max_score([(w, lists[t]) for t, w in terms if t in lists and w > 0], len(ids), order_of, nearest)
            out.append((np.full(len(found), item), found, scores))
        item, found, score = (np.concatenate(c) for c in zip(*out))
        return pa.table({"item": pa.array(item), "id": ids.take(pa.array(found)), "score": pa.array(score)})

    return run


def search(index: DataFrame, items: DataFrame, item_column: str = "item_id", text_column: str = "text", nearest: int = 50) -> DataFrame:
    """`item_id`, `rank`, `doc_id`, `score` of the documents with the highest scores above 0 for every item.

    Equal scores go by ascending document id, null last.  Every row of `items` is searched by
    itself, also where its id repeats or is null; an item without terms, or whose terms no document holds, has
    no rows.  Repeated documents rank as rows of their own.  An empty table on either side gives no rows.
    """
    spark = index.sparkSession
    tables, lists = index.filter(F.col("term").isNull()), index.filter(F.col("term").isNotNull())
    n = tables.select(F.filter("lengths", lambda n: n > 0).alias("n"))
    size = n.agg(F.sum(F.size("n")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda x, y: x + y))).first()
    corpus = Corpus(size[0] or 0, size[1] or 0)
    rows = cut_lineage(_texts(items, item_column, text_column).withColumn("item", F.monotonically_increasing_id()), "items")
    terms = cut_lineage(_item_terms(rows), "terms")
    df = lists.select("term", "df").join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(corpus.documents) + 2) / (2 * F.col("df") + 1)))
    blocks = -(-terms.count() // ITEM_TERMS)
    weighted = cut_lineage(
        terms.join(df, "term").groupBy("item").agg(F.collect_list(F.struct("term", weight.alias("w"))).alias("terms"))
        .withColumn("block", F.pmod(F.xxhash64("item"), F.lit(max(blocks, 1)))),
        "weights",
    )
    kind = dict(index.dtypes)["ids"].removeprefix("array<").removesuffix(">")
    found = None
    for block in range(max(blocks, 1)):
        # One bounded block of items at a time: some ITEM_TERMS terms, and the longest item.
        chosen = weighted.filter(F.col("block") == block)
        questions = spark.sparkContext.broadcast([(r["item"], [(t["term"], t["w"]) for t in r["terms"]]) for r in chosen.collect()])
        wanted = chosen.select(F.explode("terms.term").alias("term")).distinct()
        some = lists.join(F.broadcast(wanted), "term", "left_semi").unionByName(tables)
        best = some.groupBy("shard").applyInArrow(_searcher(questions, corpus, nearest), f"item bigint, id {kind}, score bigint")
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    named = ranked.join(rows.select("item", F.col("id").alias("item_id")), "item")
    return named.select(F.col("item_id").alias(item_column), "rank", F.col("id").alias("doc_id"), "score")


SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), tf AS (
  SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, unnest(terms) AS term FROM d) GROUP BY ALL
), size AS (
  SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0
), m AS (
  SELECT r, 100 - 50 + (50 * len(terms) * n_docs) // n_terms AS m FROM d, size WHERE len(terms) > 0
), items AS (
  SELECT row_number() OVER () AS i, item_id,
         list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM benchmark
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM df, size
), scored AS (
  SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM (SELECT i, item_id, unnest(terms) AS term FROM items) JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r)
  GROUP BY i, item_id, r, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 50
"""
