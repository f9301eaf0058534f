"""Texts of an Arrow batch as one byte buffer, and what numpy can tell about it.

Words are runs of bytes other than ``20 09-0D`` (hex). These bytes never occur inside a UTF-8
sequence, so word borders found in bytes are those found in code points. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``limit`` bytes of text, or one longer row each."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        ends = np.cumsum(_lengths(batch.column(column)))
        at = 0
        while at < rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _lengths(column: pa.Array) -> np.ndarray:
    return np.diff(_offsets(column.fill_null("")))


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], kind) if column.buffers()[1] else np.zeros(1, kind)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts of ``column``, and where each text starts (with the end of the last)."""
    column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = _offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of words before it (with their total)."""
    inside = ~SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(raw))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    if kind not in _powers or len(_powers[kind]) < n:
        base = _BASE if kind == "up" else np.uint64(pow(int(_BASE), -1, 1 << 64))
        out = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        out[0] = 1
        _powers[kind] = np.multiply.accumulate(out)
    return _powers[kind]


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``n``, or the inverses."""
    return _power("down" if inverse else "up", n)[:n]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, equal for equal bytes wherever they stand."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _power("up", len(raw))[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("down", len(raw) + 1)[starts] + (ends - starts).astype(np.uint64))


def grams(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, at the first word, and whether the run lies in one text.

    ``counts``: as the third value of :func:`words`.
    """
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total = np.zeros(n - k + 1, np.uint64)
    factor = 1
    for j in range(k):
        total += hashes[j : n - k + 1 + j] * np.uint64(factor)
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
    whole = np.ones(n - k + 1, bool)
    for j in range(1, k):  # no run starts among the last k - 1 words of a text
        at = counts[1:-1] - j
        whole[at[(at >= 0) & (at < n - k + 1)]] = False
    return mix(total), whole


def owners(counts: np.ndarray) -> np.ndarray:
    """The number of the text that each word belongs to."""
    return np.repeat(np.arange(len(counts) - 1), np.diff(counts))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...``, ``lengths[i]`` numbers for each i, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)
