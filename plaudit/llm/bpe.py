"""Byte-level BPE encoding and decoding with a public vocabulary file.

A word is held as its part boundaries and one contiguous array with the rank of every
adjacent pair.  The array is scanned for the smallest rank again and again, the boundary
between its two parts is deleted, and the ranks of the new part's neighbours are refreshed;
numpy does this for all new words of a few hundred texts together.  Scanning is quadratic in
the length of a word, so words over `SHORT` bytes take their next pair from a heap instead,
with the same result.  Encoded words are kept per Python worker, up to a fixed number.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from plaudit.llm.words import free_name, releasing

# Fixed value: the pattern of the vocabulary's pre-tokenizer.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# White space before a space, or a space at the end.
RAGGED = regex.compile(r"\s | $")
SHORT = 128
KEPT_WORDS = 120_000
KEPT_LETTERS = 24
NEVER = 2**31 - 1
# The hash table of ranks: a tenth of the slots is filled by 50,000 merges.
SLOT_BITS = 19
EMPTY = np.uint64(2**64 - 1)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Recent:
    """A bounded memory: the entries since the last turn and those of the turn before."""

    def __init__(self, size: int = KEPT_WORDS):
        self.size, self.recent, self.older = size, {}, {}

    def get_all(self, keys: set[str]) -> dict[str, tuple[int, ...]]:
        found = {key: self.recent[key] for key in keys & self.recent.keys()}
        again = {key: self.older[key] for key in (keys - found.keys()) & self.older.keys()}
        self.put_all(again.items())
        return found | again

    def put_all(self, entries) -> None:
        for key, value in entries:
            if len(key) <= KEPT_LETTERS:
                if len(self.recent) >= self.size:
                    self.recent, self.older = {}, self.recent
                self.recent[key] = value


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else one from 256 up."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Ranks of pairs, ids of bytes and bytes of ids, read from a tokenizer file."""

    def __init__(self, content: str):
        file = json.loads(content)
        ids = file["model"]["vocab"]
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.first = np.array([ids[letter] for letter in letters], np.int32)
        self.ranks, joined = {}, []
        for rank, pair in enumerate(file["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[a], ids[b]] = rank
            joined.append(ids[a + b])
        self.joined = np.array(joined, np.int32)
        # The ranks as an open hash table, for looking up many pairs at once.
        self.slot_key = np.full(1 << SLOT_BITS, EMPTY, np.uint64)
        self.slot_rank = np.full(1 << SLOT_BITS, NEVER, np.int32)
        for (a, b), rank in self.ranks.items():
            key = (a << 32) | b
            slot = (key * int(SPREAD) % 2**64) >> (64 - SLOT_BITS)
            while self.slot_key[slot] != EMPTY:
                slot = (slot + 1) % (1 << SLOT_BITS)
            self.slot_key[slot], self.slot_rank[slot] = key, rank
        left, right = np.meshgrid(self.first, self.first, indexing="ij")
        self.first_rank = self._rank(left.ravel(), right.ravel()).reshape(256, 256)
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            if token not in self.special:
                self.bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.text = [str(i) for i in range(len(self.bytes))]
        self.apart = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words, self.runs = Recent(), Recent()

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NEVER where there is none."""
        key = (a.astype(np.uint64) << np.uint64(32)) | (b.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slot = (key * SPREAD) >> np.uint64(64 - SLOT_BITS)
        at = self.slot_key[slot]
        found = np.where(at == key, self.slot_rank[slot], NEVER)
        open_ = np.flatnonzero((at != key) & (at != EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + np.uint64(1)) & np.uint64((1 << SLOT_BITS) - 1)
            at = self.slot_key[slot[open_]]
            hit = at == key[open_]
            found[open_[hit]] = self.slot_rank[slot[open_[hit]]]
            open_ = open_[~hit & (at != EMPTY)]
        return found

    def _merge_short(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Merge many words of similar length at once; row i of every array belongs to word i.

        `part` holds the id at each boundary that is left, -1 at deleted ones, and `rank`
        the rank of the part with its right neighbour.
        """
        n, width = len(words), max(map(len, words))
        letters = np.frombuffer(b"".join(w.ljust(width + 1, b"\0") for w in words), np.uint8).reshape(n, width + 1)
        length = np.array([len(w) for w in words])
        place = np.arange(width + 1)
        part = np.where(place < length[:, None], self.first[letters], -1)
        after, before = np.tile(place + 1, (n, 1)), np.tile(place - 1, (n, 1))
        rank = np.full((n, width + 1), NEVER, np.int32)
        rank[:, :-1] = np.where(place[1:] < length[:, None], self.first_rank[letters[:, :-1], letters[:, 1:]], NEVER)
        rows = np.arange(n)
        while len(rows):
            i = rank[rows].argmin(axis=1)
            least = rank[rows, i]
            live = least < NEVER
            rows, i, least = rows[live], i[live], least[live]
            j = after[rows, i]
            k = after[rows, j]
            merged = self.joined[least]
            part[rows, i], part[rows, j], rank[rows, j] = merged, -1, NEVER
            after[rows, i] = k
            inside = k < length[rows]
            before[rows[inside], k[inside]] = i[inside]
            rank[rows, i] = NEVER
            rank[rows[inside], i[inside]] = self._rank(merged[inside], part[rows[inside], k[inside]])
            left = before[rows, i]
            inside = left >= 0
            rank[rows[inside], left[inside]] = self._rank(part[rows[inside], left[inside]], merged[inside])
        kept = part >= 0
        ids, ends = part[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
        return [tuple(ids[x:y]) for x, y in zip([0, *ends[:-1]], ends)]

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each word: its pairs merged as long as one has a rank, the smallest first."""
        done: list[tuple[int, ...]] = [()] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        short = bisect_right(order, SHORT, key=lambda i: len(words[i]))
        for start in range(0, short, 4096):
            chosen = order[start : min(start + 4096, short)]
            for i, ids in zip(chosen, self._merge_short([words[i] for i in chosen])):
                done[i] = ids
        for i in order[short:]:
            done[i] = tuple(self._merge_long([int(self.first[b]) for b in words[i]]))
        return done

    def _merge_long(self, parts: list[int]) -> list[int]:
        find, n = self.ranks.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i) for i, pair in enumerate(zip(parts, parts[1:])) if (rank := find(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            # An entry is stale once either part was merged meanwhile.
            if parts[i] < 0 or j >= n or find((parts[i], parts[j])) != rank:
                continue
            parts[i], parts[j] = int(self.joined[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (rank := find((parts[i], parts[after[i]]))) is not None:
                    heapq.heappush(heap, (rank, i))
            if before[i] >= 0 and (rank := find((parts[before[i]], parts[i]))) is not None:
                heapq.heappush(heap, (rank, before[i]))
        return [part for part in parts if part >= 0]

    def _lookup(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        """Ids of words, from memory where it has them."""
        found = self.words.get_all(words)
        missing = [word for word in words if word not in found]
        found.update(zip(missing, self.merge([word.encode() for word in missing])))
        self.words.put_all((word, found[word]) for word in missing)
        return found

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text; the words of all texts are merged together."""
        plans, words, runs = [], set(), set()
        for text in texts:
            plan = []
            for piece in self.apart.split(text) if self.apart else [text]:
                if piece in self.special:
                    plan.append((self.special[piece], (), ()))
                elif piece:
                    # A space after a letter, digit or sign always begins a word, so what lies between
                    # such spaces is looked up whole.  After white space it may join that word instead.
                    begin, *rest = [piece] if RAGGED.search(piece) else piece.split(" ")
                    begin = WORDS.findall(begin)
                    words.update(begin)
                    runs.update(rest)
                    plan.append((None, begin, rest))
            plans.append(plan)
        known = self.runs.get_all(runs)
        missing = {run: WORDS.findall(" " + run) for run in runs if run not in known}
        words.update(*missing.values())
        word_ids = self._lookup(words)
        for run, parts in missing.items():
            known[run] = word_ids[parts[0]] if len(parts) == 1 else tuple(chain.from_iterable(map(word_ids.__getitem__, parts)))
        self.runs.put_all((run, known[run]) for run in missing)
        encoded = []
        for plan in plans:
            ids: list[int] = []
            for special, begin, rest in plan:
                if special is not None:
                    ids.append(special)
                ids.extend(chain.from_iterable(map(word_ids.__getitem__, begin)))
                ids.extend(chain.from_iterable(map(known.__getitem__, rest)))
            encoded.append(ids)
        return encoded

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _with_vocabulary(df: DataFrame, path: str):
    """The vocabulary file, read by the driver and sent once to every executor; its size is that of one file."""
    return df.sparkSession.sparkContext.broadcast(_read(path))


def _each(df: DataFrame, column: str, types: list[tuple[str, pa.DataType, object]], values, path: str) -> DataFrame:
    """`df` with columns computed from `column`, a list of rows at a time.

    New columns replace old ones of the same name.
    """
    file = _with_vocabulary(df, path)
    kept = [c for c in df.columns if c not in {name for name, _, _ in types}]
    letters = free_name(kept, "given")
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias(letters))
    schema = source.drop(letters).schema
    for name, _, kind in types:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(file.value)
        for batch in batches:
            # Few rows at a time, so that the ids of long texts do not pile up.
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                given = part.column(part.num_columns - 1)
                made = values(vocabulary, given)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *[pa.array(v, t) for v, (_, t, _) in zip(made, types)]],
                    names=[*kept, *[name for name, _, _ in types]],
                )

    return source.mapInArrow(releasing(run), schema)


def encode(df: DataFrame, path: str, text_column: str = "text", ids_column: str = "ids", decoded_column: str | None = None) -> DataFrame:
    """Add the token ids of a text as an array; null and empty texts give an empty array.

    Strings of special tokens in a text are encoded as those tokens.  Rows keep their
    other columns and are neither merged nor moved, so repeated rows stay.  With
    `decoded_column` the ids are decoded again by the same worker.
    """
    types = [(ids_column, pa.list_(pa.int32()), T.ArrayType(T.IntegerType()))]
    if decoded_column:
        types.append((decoded_column, pa.string(), T.StringType()))

    def values(vocabulary: Vocabulary, given: pa.Array):
        encoded = vocabulary.encode([text or "" for text in given.to_pylist()])
        return [encoded, [vocabulary.decode(ids) for ids in encoded]] if decoded_column else [encoded]

    return _each(df, text_column, types, values, path)


def decode(df: DataFrame, path: str, ids_column: str = "ids", text_column: str = "text") -> DataFrame:
    """Add the text of an array of token ids, special tokens included; null gives an empty text.

    Bytes that are no UTF-8, which only cut or foreign id lists hold, become U+FFFD.
    """

    def values(vocabulary: Vocabulary, given: pa.Array):
        return [[vocabulary.decode(ids.as_py() or ()) for ids in given]]

    return _each(df, ids_column, [(text_column, pa.string(), T.StringType())], values, path)


def round_trip(df: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """Encode every text and decode its ids within one task: `n_tokens` and digests of ids and text.

    `ids_sha256` is over the decimal ids joined by commas, `decoded_sha256` over the decoded
    text in UTF-8, both in lowercase hexadecimal.  The ids themselves stay in the task.
    """

    def values(vocabulary: Vocabulary, given: pa.Array):
        counts, encoded, decoded = [], [], []
        for ids in vocabulary.encode([text or "" for text in given.to_pylist()]):
            counts.append(len(ids))
            encoded.append(hashlib.sha256(",".join(map(vocabulary.text.__getitem__, ids)).encode()).hexdigest())
            decoded.append(hashlib.sha256(vocabulary.decode(ids).encode()).hexdigest())
        return counts, encoded, decoded

    types = [("n_tokens", pa.int64(), T.LongType()), ("ids_sha256", pa.string(), T.StringType()),
             ("decoded_sha256", pa.string(), T.StringType())]
    return _each(df, text_column, types, values, path)
