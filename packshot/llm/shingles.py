"""Sets of hashed word shingles of texts, and hash filters of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packshot.llm import arrow_text

_SHORT = np.uint64(0xA0761D6478BD642F)


def word_hashes(part: pa.RecordBatch, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and, for each text, the number of words before it."""
    raw, offsets = arrow_text.buffer(part.column("text"))
    starts, ends, first = arrow_text.words(raw, offsets)
    return arrow_text.span_hashes(arrow_text.LOWER[raw] if lower else raw, starts, ends), first


def text_shingles(part: pa.RecordBatch, k: int, short: bool = True) -> Iterator[np.ndarray]:
    """The distinct ``k``-word shingles of each text, sorted; fewer words are one shingle if ``short``, none else."""
    hashes, first = word_hashes(part)
    grams, _ = arrow_text.grams(hashes, first, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a and short:
            total = np.array([b - a], np.uint64) * _SHORT
            for i in range(a, b):
                total = arrow_text.mix(total + hashes[i : i + 1])
            yield total
        else:
            yield np.zeros(0, np.uint64)


def filter_bits(n: int, least: int = 1 << 20, most: int = 1 << 28) -> int:
    """A power of two of some 16 bits per key, at most 32 MB."""
    bits = least
    while bits < 16 * n and bits < most:
        bits *= 2
    return bits


def hash_filter(keys: DataFrame, key: Column, bits: int) -> np.ndarray:
    """A byte array with bit ``key mod bits`` set for each key; false hits only cost work downstream.

    Built by a partial aggregate; the driver gets at most ``bits / 8`` bytes.
    """
    at = F.pmod(key, F.lit(bits)).cast("long")
    each = 4096 * 8  # bits of a map
    maps = (
        keys.select(at.alias("at"))
        .where("at is not null")
        .groupBy(F.floor(F.col("at") / each).alias("map_no"))
        .agg(F.bitmap_construct_agg(F.col("at") % each).alias("map"))
    )
    out = np.zeros((bits // each, each // 8), np.uint8)
    for row in maps.collect():
        out[row["map_no"]] = np.frombuffer(row["map"], np.uint8)
    return out.ravel()


def in_filter(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which 64-bit keys may be in ``table`` (keys taken as signed, as Spark's are)."""
    at = keys.view(np.uint64) & np.uint64(len(table) * 8 - 1)
    return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
