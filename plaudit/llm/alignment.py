"""Alignment of two tokenizers over the same texts.

A tokenization is a sparse matrix with a row per token and a column per byte of the text.  Both
matrices are built by hand in compressed rows (CSR); Gustavson's row products A Bᵀ give a link
for every two tokens whose bytes overlap, with the number of bytes they share.  Offsets where
tokens of both end cut the text into groups; products of the group-incidence matrices give the
links of tokens that share a group.  Many texts are worked on together, one after the other in
one byte space, and no token crosses the end of its text.

How often two ids are linked in the corpus is counted in two steps.  Every chunk of texts
keeps its distinct id pairs once, its documents refer to them by number; the distinct pairs of
all chunks are summed by pair, and the sums go back to the chunks.  So what is shuffled are
pairs per chunk, not links, and a pair that every text holds is one row per chunk.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plaudit.llm.bpe import byte_letters
from plaudit.session import cut_lineage

CHUNK_BYTES = 2 << 20
# Links given out at once by `token_links`.
LINK_ROWS = 1 << 16
LOW = np.int64(2**32 - 1)


@dataclass(frozen=True)
class Csr:
    """A sparse 0/1 matrix: the columns of row i are columns[starts[i]:starts[i + 1]], in ascending order."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def of_spans(cls, ends: np.ndarray) -> Csr:
        """Rows that take all columns one after the other; row i ends before column ends[i]."""
        width = int(ends[-1]) if len(ends) else 0
        return cls(np.concatenate([[0], ends]).astype(np.int64), np.arange(width), width)

    @classmethod
    def of_groups(cls, groups: np.ndarray, width: int) -> Csr:
        """One column per row: its group."""
        return cls(np.arange(len(groups) + 1), groups, width)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(self.height), np.diff(self.starts))
        if (self.columns[1:] < self.columns[:-1]).any():
            rows = rows[np.argsort(self.columns, kind="stable")]
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, rows, self.height)

    def rows(self, first: int, last: int) -> Csr:
        starts = self.starts[first : last + 1]
        return Csr(starts - starts[0], self.columns[starts[0] : starts[-1]], self.width)

    def reach(self, other: Csr) -> np.ndarray:
        """Per row, the terms of its product with `other` before equal columns are added up."""
        terms = np.concatenate([[0], np.cumsum(np.diff(other.starts)[self.columns])])
        return np.diff(terms[self.starts])

    def times(self, other: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gustavson's product: (row, column, value) of what is not zero, by row and column.

        Every entry (i, k) of this matrix adds row k of `other` to row i of the result.
        """
        counts = np.diff(other.starts)[self.columns]
        begin = np.cumsum(counts) - counts
        at = np.arange(int(counts.sum())) - np.repeat(begin - other.starts[self.columns], counts)
        row = np.repeat(np.repeat(np.arange(self.height), np.diff(self.starts)), counts)
        key = row * other.width + other.columns[at]
        if len(key) > 1 and (key[1:] < key[:-1]).any():
            key = np.sort(key)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        value = np.diff(np.r_[first, len(key)])
        return key[first] // max(other.width, 1), key[first] % max(other.width, 1), value


class Pair:
    """Both tokenizers: ids of texts, bytes of ids."""

    def __init__(self, bpe: str, pieces: bytes):
        import sentencepiece
        import tiktoken

        from plaudit.llm.bpe import WORDS

        file = json.loads(bpe)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in file["model"]["vocab"].items() if token not in special}
        # Ranks are ids here: the file lists merges in the order of the ids they give.
        self.a = tiktoken.Encoding("a", pat_str=WORDS.pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor()
        self.b.LoadFromSerializedProto(pieces)
        a_bytes = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for token, i in ranks.items():
            a_bytes[i] = token
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.large_binary()), pa.array(b_bytes, pa.large_binary())
        self.a_size, self.b_size = (np.array([len(x) for x in table]) for table in (a_bytes, b_bytes))
        # Decimal ids with the separators that can follow: , | for A and , ; for B.
        names = [f"{i}{mark}".encode() for table, marks in ((a_bytes, ",|"), (b_bytes, ",;")) for mark in marks for i in range(len(table))]
        self.names = pa.array(names, pa.large_binary())

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        return self.a.encode_ordinary(" " + text), self.b.encode(text)


@lru_cache(maxsize=1)
def _pair(bpe: str, pieces: bytes) -> Pair:
    return Pair(bpe, pieces)


def _joined(table: pa.Array, ids: np.ndarray) -> memoryview:
    """The entries of `ids` one after the other."""
    buffer = table.take(pa.array(ids)).buffers()[2]
    return memoryview(buffer).cast("B") if buffer is not None else memoryview(b"")


@dataclass
class Aligned:
    """Tokens of several texts in one byte space; `a_doc` and `b_doc` are the first tokens of each text (texts + 1)."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    groups: int

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(A token, B token, bytes shared) of every two that overlap."""
        return Csr.of_spans(self.a_ends).times(Csr.of_spans(self.b_ends).transposed())

    def shared_group_links(self, most: int = LINK_ROWS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The same for every two in one group, rows of A in runs of about `most` links."""
        left = Csr.of_groups(self.a_group, self.groups)
        right = Csr.of_groups(self.b_group, self.groups).transposed()
        total = np.cumsum(left.reach(right))
        first = 0
        while first < len(self.a):
            done = total[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(total, done + most, "right")))
            row, column, value = left.rows(first, last).times(right)
            yield row + first, column, value
            first = last


def align(texts: list[str | None], pair: Pair) -> Aligned:
    """Tokens and groups of some texts; a text that either tokenizer does not give back has none."""
    a, b = [], []
    for text in texts:
        ids = pair.encode(text) if text else ([], [])
        a.append(np.array(ids[0], np.int64))
        b.append(np.array(ids[1], np.int64))
    whole = [(" " + text).encode() if text else b"" for text in texts]
    for ids, table, sizes in ((a, pair.a_bytes, pair.a_size), (b, pair.b_bytes, pair.b_size)):
        all_ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        given, at = _joined(table, all_ids), 0
        for i, of in enumerate(ids):
            size = int(sizes[of].sum())
            if given[at : at + size] != whole[i]:
                whole[i] = None
            at += size
    for i, text in enumerate(whole):
        if text is None:
            a[i] = b[i] = np.zeros(0, np.int64)
    a_doc, b_doc = (np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64) for ids in (a, b))
    a, b = np.concatenate([*a, np.zeros(0, np.int64)]), np.concatenate([*b, np.zeros(0, np.int64)])
    a_ends, b_ends = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
    cut = np.zeros((2, int(a_ends[-1]) + 1 if len(a) else 1), bool)
    cut[0, a_ends] = cut[1, b_ends] = True
    cut = cut.all(axis=0)
    # The group of a token: the cuts before its end.
    a_group, b_group = (np.cumsum(cut[ends]) - cut[ends] for ends in (a_ends, b_ends))
    return Aligned(a, b, a_ends, b_ends, a_doc, b_doc, a_group, b_group, int(cut.sum()))


def _per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[starts])


def group_digests(found: Aligned, pair: Pair) -> tuple[np.ndarray, list[str]]:
    """Groups per text and the digest of `a1,a2|b1;a3|b2,b3` (empty without tokens)."""
    last_a = np.r_[found.a_group[1:] != found.a_group[:-1], True][: len(found.a)]
    last_b = np.r_[found.b_group[1:] != found.b_group[:-1], True][: len(found.b)]
    kinds_a, kinds_b = len(pair.a_bytes), len(pair.b_bytes)
    # The place of a token: its own side before it, and the other side's groups before it (A stands first).
    until_a, until_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=found.groups))]) for g in (found.a_group, found.b_group))
    a_place = np.arange(len(found.a)) + until_b[found.a_group]
    b_place = np.arange(len(found.b)) + until_a[found.b_group + 1]
    name = np.zeros(len(found.a) + len(found.b), np.int64)
    name[a_place] = found.a + kinds_a * last_a
    name[b_place] = 2 * kinds_a + found.b + kinds_b * last_b
    chosen = pair.names.take(pa.array(name))
    ends = np.frombuffer(chosen.buffers()[1], np.int64)[: len(name) + 1] if len(name) else np.zeros(1, np.int64)
    letters = memoryview(chosen.buffers()[2]) if len(name) else memoryview(b"")
    edges = ends[found.a_doc + found.b_doc]
    digests = [hashlib.sha256(letters[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(edges[:-1], edges[1:])]
    return _per_text(last_a, found.a_doc), digests


def _chunks(column: pa.Array, size: int) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of runs of about `size` characters; a longer text is a run of its own."""
    first, texts, held = 0, [], 0
    for i, text in enumerate(column):
        text = text.as_py()
        if texts and held + len(text or "") > size:
            yield first, texts
            first, texts, held = i, [], 0
        texts.append(text)
        held += len(text or "")
    if texts:
        yield first, texts


def _file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _with_files(docs: DataFrame, bpe_path: str, piece_path: str):
    """Both files, read by the driver and sent once to every executor; their size is that of one vocabulary each."""
    context = docs.sparkSession.sparkContext
    return context.broadcast((_file(bpe_path).decode(), _file(piece_path)))


def token_links(docs: DataFrame, bpe_path: str, piece_path: str, shared_groups: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`a_index`, `b_index`, `a_id`, `b_id`, `weight` of all linked tokens of every document, counted from 0.

    By default tokens are linked when their bytes overlap and `weight` is the bytes they share;
    with `shared_groups` they are linked when they stand in one group, with weight 1.  The id
    column is kept as it is.  Documents without tokens have no rows.
    """
    files = _with_files(docs, bpe_path, piece_path)
    chosen = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*files.value)
        for batch in batches:
            for first, texts in _chunks(batch.column(1), CHUNK_BYTES):
                found = align(texts, pair)
                for a, b, weight in found.shared_group_links() if shared_groups else [found.links()]:
                    doc = np.searchsorted(found.a_doc, a, "right") - 1
                    for at in range(0, len(a), LINK_ROWS):
                        cut = slice(at, at + LINK_ROWS)
                        columns = (a - found.a_doc[doc], b - found.b_doc[doc], found.a[a], found.b[b], weight)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(first + doc[cut])), *[pa.array(c[cut]) for c in columns]],
                            ["id", "a_index", "b_index", "a_id", "b_id", "weight"],
                        )

    kind = dict(chosen.dtypes)["id"]
    links = chosen.mapInArrow(run, f"id {kind}, a_index bigint, b_index bigint, a_id bigint, b_id bigint, weight bigint")
    return links.withColumnRenamed("id", id_column)


def _counted(texts: list[str | None], pair: Pair) -> dict:
    """What a chunk keeps: figures and digests per text, distinct id pairs, and which text holds which of them how often."""
    found = align(texts, pair)
    a, b, _ = found.links()
    n_groups, digests = group_digests(found, pair)
    per_text = np.diff(np.searchsorted(a, found.a_doc))
    # Sizes of groups on both sides multiply to the links of tokens that share a group.
    in_group = np.bincount(found.b_group, minlength=found.groups)[found.a_group]
    figures = [np.diff(found.a_doc), np.diff(found.b_doc), n_groups, per_text, _per_text(in_group, found.a_doc)]
    pairs, at, counts = np.unique((found.a[a] << np.int64(32)) | found.b[b], return_inverse=True, return_counts=True)
    doc = np.repeat(np.arange(len(texts)), per_text)
    held, times = np.unique(doc * max(len(pairs), 1) + at, return_counts=True)
    ends = np.searchsorted(held, (np.arange(len(texts)) + 1) * max(len(pairs), 1))
    return {
        "figures": np.array(figures, np.int64).T.ravel(), "digests": digests, "pairs": pairs, "counts": counts,
        "ends": ends, "which": (held % max(len(pairs), 1)).astype(np.uint32).tobytes(), "times": times.astype(np.uint32).tobytes(),
    }


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_shared_group_links")
CHUNK = "figures array<bigint>, digests array<string>, pairs array<bigint>, counts array<bigint>, ends array<bigint>, which binary, times binary"


def _chunk_table(docs: DataFrame, files, chunk_bytes: int) -> DataFrame:
    """One row per run of texts, numbered in `chunk`, written once."""
    kinds = [pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.list_(pa.int64())] * 3, pa.binary(), pa.binary()]
    names = ["ids", *[c.split()[0] for c in CHUNK.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*files.value)
        for batch in batches:
            for first, texts in _chunks(batch.column(1), chunk_bytes):
                made = _counted(texts, pair)
                ids = batch.column(0).slice(first, len(texts))
                ids = pa.array([ids.to_pylist()], pa.list_(ids.type))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array([v], kind) for v, kind in zip(made.values(), kinds)]], names)

    kind = dict(docs.dtypes)["id"]
    chunks = docs.mapInArrow(run, f"ids array<{kind}>, {CHUNK}")
    return cut_lineage(chunks.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


def alignment(
    docs: DataFrame, bpe_path: str, piece_path: str, id_column: str = "doc_id", text_column: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """How the tokens of both vocabularies fit on every document, one row per input row.

    `n_a`, `n_b`, `n_groups`, `n_links` (overlapping token pairs), `n_shared_group_links`,
    `n_best` (links whose id pair is, ties included, the most frequent of its B id in the whole
    corpus), `count_sum` (over the links, how often their id pair is linked in the corpus) and
    `groups_sha256`.  A null or empty text, and one that either vocabulary does not give back
    byte for byte, has no tokens: zeros and an empty digest.  Repeated rows count as often as
    they occur; a null id is kept.  An empty table gives no rows; other columns are not carried
    along and may have any name.  Memory follows the longest text.
    """
    files = _with_files(docs, bpe_path, piece_path)
    chosen = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    chunks = _chunk_table(chosen, files, chunk_bytes)
    pairs = chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "pair")).select(
        "chunk", "at", F.col("pair.pairs").alias("pair"), F.col("pair.counts").alias("n")
    )
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(F.lit(int(LOW))))
    counts = cut_lineage(counts, "counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    ranked = counts.join(most, "b").select("pair", F.col("n").alias("total"), (F.col("n") == F.col("most")).alias("best"))
    answers = pairs.select("chunk", "at", "pair").join(ranked, "pair").select(F.col("chunk").alias("of_chunk"), "at", "total", "best")

    def finish(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row = {name: chunk.column(name)[0].as_py() for name in ("figures", "digests", "ends", "which", "times")}
        n = np.zeros(answers.num_rows, np.int64)
        best = np.zeros(answers.num_rows, np.int64)
        at = answers.column("at").to_numpy()
        n[at], best[at] = answers.column("total").to_numpy(), np.array(answers.column("best").to_pylist(), np.int64)
        which, times = np.frombuffer(row["which"], np.uint32), np.frombuffer(row["times"], np.uint32).astype(np.int64)
        starts = np.concatenate([[0], row["ends"]]).astype(np.int64)
        figures = np.array(row["figures"], np.int64).reshape(-1, len(FIGURES))
        columns = [*figures.T, _per_text(times * best[which], starts), _per_text(times * n[which], starts)]
        return pa.Table.from_arrays(
            [chunk.column("ids").combine_chunks().flatten(), *[pa.array(c) for c in columns], pa.array(row["digests"], pa.string())],
            ["id", *FIGURES, "n_best", "count_sum", "groups_sha256"],
        )

    figures = ", ".join(f"{name} bigint" for name in (*FIGURES, "n_best", "count_sum"))
    texts = chunks.select("chunk", "ids", "figures", "digests", "ends", "which", "times")
    types = f"id {dict(chosen.dtypes)['id']}, {figures}, groups_sha256 string"
    made = texts.groupBy("chunk").cogroup(answers.groupBy("of_chunk")).applyInArrow(finish, types)
    return made.withColumnRenamed("id", id_column)
