"""Words, shingles and n-grams of many texts at once, as 64-bit hashes in numpy.

A batch is the byte buffer of its texts; nothing is done per word in Python.
All values are unsigned 64-bit numbers that wrap around.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# ASCII white space of the word pattern [^\x20\x09-\x0D]+.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS)] = True
_random = np.random.Generator(np.random.PCG64(20240601))
# A random number for each byte; A-Z share those of a-z.
BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64)
BYTE_VALUE[ord("A") : ord("Z") + 1] = BYTE_VALUE[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
CHUNK_BYTES = 1 << 20
LEAST_POWERS = 1 << 12

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        # As many as are needed, in doubling steps: every worker keeps them for each base.
        size = 1 << int(max(n, LEAST_POWERS) - 1).bit_length()
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        _powers[base] = known
    return known[:n]


def free_name(columns: list[str], name: str) -> str:
    """`name`, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def give_back() -> None:
    """Hand the freed memory of this Python worker back to the system; the worker lives on beside a JVM that needs it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run` over a partition, with its memory given back at the end."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of runs of rows holding about `chunk_bytes`; a null is empty.

    A single longer text is a run of its own, so memory follows the longest text.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + chunk_bytes, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last - first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word, A-Z lower-cased, and the position of each text's first word (rows + 1 entries)."""
    size = len(data)
    if size == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    full = ~IS_BLANK[data]
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    starts = full.copy()
    starts[1:] &= ~full[:-1] | edge[1:size]
    ends = full.copy()
    ends[:-1] &= ~full[1:] | edge[1:size]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers(_BASE, size), out=total[1:], dtype=np.uint64)
    hashes = (total[ends + 1] - total[starts]) * powers(_BASE_INVERSE, size)[starts]
    return mix(hashes ^ (ends - starts + 1).astype(np.uint64)), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: `width` words each, or all words if fewer."""
    words, first = word_hashes(data, offsets)
    joined = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    factors = powers(0xD6E8FEB86659FD93, width + 1)[1:]
    for i in range(width):
        joined += words[i : i + len(joined)] * factors[i]
    joined = mix(joined)
    for begin, end in zip(first[:-1], first[1:]):
        n = int(end - begin)
        if n >= width:
            yield np.unique(joined[begin : end - width + 1])
        elif n:
            short = (words[begin:end] * factors[:n]).sum(dtype=np.uint64) + np.uint64(n)
            yield mix(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
