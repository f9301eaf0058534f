"""Fill-in-middle examples, cut by a learned index over the boundaries of a text's units.

A unit is a word with the white space before it; white space that no word follows is a unit too. The
boundary of rank ``k`` is the code point offset behind the first ``k`` units. Ranks and offsets of a
text lie close to a few lines: :func:`fit` covers them by segments that are nowhere off by more than
``error`` (a cone from the segment's first point, narrowed until it closes) and keeps what is missing as
residuals of a byte each. A cut is the prediction of its segment plus its residual, so it is exact
without the offsets being kept (:class:`BoundaryIndex`, stored by :func:`boundary_index`).

The two cuts, whether a text is transformed and in which order its parts come follow from a hash of
``doc_id`` (a null id hashes as no digits). Null texts count as empty. Empty texts and texts that hold
a marker stay plain, so every output can be taken apart again (:func:`restored`). Rows that repeat a
document give a row each; further columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packshot.llm import arrow_text

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
ERROR = 126  # residuals of rounded predictions fit a byte
FIRST_STEP = 256

EXAMPLES = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
INDEX = "doc_id long, n long, first array<long>, base array<long>, slope array<double>, width int, residuals binary"


@dataclass
class BoundaryIndex:
    """Segments ``(first rank, offset there, slope)`` and the residual of every rank."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residuals: np.ndarray

    @property
    def n(self) -> int:
        return len(self.residuals) - 1

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[at] + np.floor(self.slope[at] * (ranks - self.first[at])).astype(np.int64)

    def cuts(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of ``ranks``."""
        return self.predicted(ranks) + self.residuals[ranks]


def fit(offsets: np.ndarray, error: int = ERROR) -> BoundaryIndex:
    """Index of ascending ``offsets``, with as many segments as the error bound asks for."""
    first, base, slope = [], [], []
    at, n = 0, len(offsets)
    while at < n:
        low, high, to, step = -np.inf, np.inf, at + 1, FIRST_STEP
        while to < n:
            stop = min(n, to + step)
            run = np.arange(to - at, stop - at)
            rise = (offsets[to:stop] - offsets[at]).astype(np.float64)
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            closed = np.flatnonzero(lows > highs)
            good = int(closed[0]) if len(closed) else stop - to
            if good:
                low, high = lows[good - 1], highs[good - 1]
            to += good
            if len(closed):
                break
            step *= 2
        first.append(at)
        base.append(int(offsets[at]))
        slope.append((low + high) / 2 if to > at + 1 else 0.0)
        at = to
    index = BoundaryIndex(np.array(first, np.int64), np.array(base, np.int64), np.array(slope, np.float64), np.zeros(n, np.int64))
    missing = offsets - index.predicted(np.arange(n))
    index.residuals = missing.astype(np.min_scalar_type(-int(np.abs(missing).max()) - 1) if n else np.int8)
    return index


def boundaries(raw: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each text its boundaries of rank 0 to n, in code points (``raw``, ``offsets``: ``arrow_text.buffer``)."""
    _, ends, counts = arrow_text.words(raw, offsets)
    points = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    ends = points[ends]
    for i in range(len(offsets) - 1):
        a, b = int(offsets[i]), int(offsets[i + 1])
        # white space behind the last word
        tail = points[b : b + 1] if b > a and arrow_text.SPACE[raw[b - 1]] else points[:0]
        yield np.concatenate([points[a : a + 1], ends[counts[i] : counts[i + 1]], tail]) - points[a]


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits for a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def example(text: str, index: BoundaryIndex, numbers: list[int], percent: int, spm_percent: int) -> tuple:
    """``(form, prefix_chars, middle_chars, output)`` of a text."""
    if not text or numbers[2] % 100 >= percent or any(m in text for m in MARKERS):
        return PLAIN, None, None, text
    ranks = np.sort(np.array(numbers[:2], np.int64) % (index.n + 1))
    a, b = (int(x) for x in index.cuts(ranks))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if numbers[3] % 100 < spm_percent:
        return SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _ids_and_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, error: int = ERROR) -> DataFrame:
    """One example per row of ``docs``: ``percent`` of the texts are cut, ``spm_percent`` of those with the suffix first.

    ``n`` counts units. No shuffle; a task holds the index of a text only as long as it cuts it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for part in arrow_text.chunks(batches):
            texts = part.column("text").to_pylist()
            rows = []
            for offsets, text, doc_id in zip(
                boundaries(*arrow_text.buffer(part.column("text"))), texts, part.column("doc_id").to_pylist(), strict=True
            ):
                index = fit(offsets, error)
                rows.append((index.n, *example(text or "", index, draws(seed, doc_id), percent, spm_percent)))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.record_batch([part.column("doc_id"), *columns], _columns(EXAMPLES))

    return _ids_and_texts(docs).mapInArrow(run, EXAMPLES)


def boundary_index(docs: DataFrame, error: int = ERROR) -> DataFrame:
    """The index of every text as a row, ``residuals`` as little-endian integers of ``width`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.int32(), pa.binary()]
        for part in arrow_text.chunks(batches):
            rows = []
            for offsets in boundaries(*arrow_text.buffer(part.column("text"))):
                x = fit(offsets, error)
                width = x.residuals.dtype.itemsize
                rows.append((x.n, x.first.tolist(), x.base.tolist(), x.slope.tolist(), width, x.residuals.astype(f"<i{width}").tobytes()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.record_batch([part.column("doc_id"), *columns], _columns(INDEX))

    return _ids_and_texts(docs).mapInArrow(run, INDEX)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of, taken apart at its markers. Each occurs once in an output that is not plain."""

    def between(start: str, end: str | None) -> Column:
        behind = F.split_part(F.col(output), F.lit(start), F.lit(2))
        return F.split_part(behind, F.lit(end), F.lit(1)) if end else behind

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(F.col(form) == PSM, psm).when(F.col(form) == SPM, spm).otherwise(F.col(output))


def digests(examples: DataFrame) -> DataFrame:
    """``examples`` with the digests of the output and of the text rebuilt from it, in place of the output."""
    return examples.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )
