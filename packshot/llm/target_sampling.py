"""Documents drawn by how much likelier their word runs are in a target than in the corpus.

A text is folded (A-Z to lower case) and its words are runs of ASCII letters and digits and of all
characters beyond ASCII. Features are the runs of 1 to ``max_n`` consecutive words joined by a space; the CRC-32 of its
bytes puts a feature into one of ``buckets``. A bucket's gain is the logarithm of how much larger its smoothed share is in the
target, and a document's weight is the sum over its features. Gumbel noise from a hash of ``doc_id`` turns the
highest scores into a draw without replacement, in proportion to the exponentials of the weights.

*Segments.* Line breaks cut texts into lines. For the corpus counts, equal lines of a task become one with
the number of times they stand there; these meet by content in the shuffle, where the features of each distinct line are counted
once and multiplied. For the weights, the distinct lines of a slice of texts are weighed once.
Runs of words over a line break belong to no line and are added on their own (:func:`_cross_runs`).

Null texts count as empty and have no features. A null id hashes as no digits and comes behind others
in ties. Rows that repeat a document give a row each, also in ranks. Further columns are ignored. An
empty table gives no row; an empty target leaves smoothed shares alone.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packshot.llm import arrow_text
from packshot.runtime import materialise

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
HELD_BYTES = 32 << 20  # of distinct lines in a task
LONG = 64  # longer runs have their CRC taken one by one
ROWS_PER_RANK_TASK = 1_000_000

# words: digits, letters after folding, and what is not ASCII; the rest separates
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)  # fixed value: the CRC-32 polynomial
    return table


_CRC = _crc_table()


def crc32_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span of ``raw``, a byte of all spans at a time."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    at, state = starts[order], np.full(len(starts), 0xFFFFFFFF, np.uint32)
    alive = np.searchsorted(-lengths[order], -np.arange(min(int(lengths.max(initial=0)), LONG)), side="left")
    for j, n in enumerate(alive.tolist()):
        state[:n] = _CRC[(state[:n] ^ raw[at[:n] + j]) & 0xFF] ^ (state[:n] >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order] = ~state
    for i in np.flatnonzero(lengths > LONG).tolist():
        out[i] = zlib.crc32(raw[starts[i] : ends[i]])
    return out


class _Words:
    """Words of folded texts, joined by single spaces in one buffer, so that a run of words is a span of it."""

    def __init__(self, folded: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, self.counts = arrow_text.words(folded, offsets)
        self.source = starts
        inside = folded != 0x20
        keep = inside.copy()
        keep[1:] |= inside[:-1]  # of separators the one behind a word
        self.raw = folded[keep]
        self.starts = np.cumsum(keep)[starts] - 1
        self.ends = self.starts + (ends - starts)

    def runs(self, k: int) -> np.ndarray:
        """The first words of all runs of ``k`` words inside a text."""
        first = np.arange(max(0, len(self.starts) - k + 1))
        text = arrow_text.owners(self.counts)
        return first[text[first] == text[first + k - 1]]

    def buckets(self, first: np.ndarray, k: int, buckets: int) -> np.ndarray:
        return (crc32_of(self.raw, self.starts[first], self.ends[first + k - 1]) % np.uint32(buckets)).astype(np.int64)


def _lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every line that is not empty; a line ends with its text."""
    starts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(raw == 0x0A) + 1]))
    starts = starts[starts < len(raw)]
    ends = np.append(starts[1:], len(raw))[: len(starts)]
    ends = ends - (raw[ends - 1] == 0x0A)
    some = ends > starts
    return starts[some], ends[some]


def _distinct(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each set of equal lines, and for every line the number of its set (by 128 bits and the length)."""
    keys = np.rec.fromarrays(
        [arrow_text.span_hashes(folded, starts, ends), arrow_text.span_hashes(255 - folded, starts, ends), ends - starts]
    )
    _, first, number = np.unique(keys, return_index=True, return_inverse=True)
    return first, number


def _line_counts(docs: DataFrame, held_bytes: int) -> DataFrame:
    """``(line, n)``: folded lines with the times they stand in a part of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        size = 0
        for part in arrow_text.chunks(batches):
            raw, offsets = arrow_text.buffer(part.column("text"))
            starts, ends = _lines(raw, offsets)
            folded = _FOLD[raw]
            first, number = _distinct(folded, starts, ends)
            times = np.bincount(number, minlength=len(first)).tolist()
            data = folded.tobytes()
            for a, b, n in zip(starts[first].tolist(), ends[first].tolist(), times, strict=True):
                line = data[a:b]
                if line in held:
                    held[line] += n
                else:
                    held[line] = n
                    size += b - a
            if size >= held_bytes:
                yield pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["line", "n"])
                held, size = {}, 0
        if held:
            yield pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["line", "n"])

    return docs.select("text").mapInArrow(run, "line binary, n long")


def _bucket_batch(sums: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(sums)
    return pa.record_batch([pa.array(at), pa.array(sums[at])], ["bucket", "n"])


def _line_features(lines: DataFrame, max_n: int, buckets: int, held_bytes: int) -> DataFrame:
    """``(bucket, n)`` per task: the features of each distinct line, times its occurrences."""

    def count(held: dict[bytes, int], sums: np.ndarray) -> None:
        lines = pa.array(list(held), pa.binary()).view(pa.string())
        table = pa.record_batch([lines, pa.array(list(held.values()), pa.int64())], ["line", "n"])
        for part in arrow_text.chunks([table], "line"):
            times = part.column("n").to_numpy()
            words = _Words(*arrow_text.buffer(part.column("line")))
            owner = arrow_text.owners(words.counts)
            for k in range(1, max_n + 1):
                first = words.runs(k)
                np.add.at(sums, words.buckets(first, k, buckets), times[owner[first]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        size, sums = 0, np.zeros(buckets, np.int64)
        for batch in batches:
            for line, n in zip(batch.column("line").to_pylist(), batch.column("n").to_pylist(), strict=True):
                if line in held:
                    held[line] += n
                else:
                    held[line] = n
                    size += len(line)
                if size >= held_bytes:
                    count(held, sums)
                    held, size = {}, 0
        if held:
            count(held, sums)
        yield _bucket_batch(sums)

    return lines.mapInArrow(run, "bucket long, n long")


def _cross_runs(raw: np.ndarray, offsets: np.ndarray, words: _Words, k: int) -> np.ndarray:
    """The first words of the runs of ``k`` words that lie in one text and more than one line."""
    breaks = np.cumsum(raw == 0x0A)
    line = breaks[words.source]
    first = words.runs(k)
    return first[line[first] != line[first + k - 1]]


def _cross_features(docs: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """``(bucket, n)`` per task: features that run over a line break."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for part in arrow_text.chunks(batches):
            raw, offsets = arrow_text.buffer(part.column("text"))
            words = _Words(_FOLD[raw], offsets)
            for k in range(2, max_n + 1):
                sums += np.bincount(words.buckets(_cross_runs(raw, offsets, words, k), k, buckets), minlength=buckets)
        yield _bucket_batch(sums)

    return docs.select("text").mapInArrow(run, "bucket long, n long")


def feature_counts(docs: DataFrame, max_n: int = 1, buckets: int = BUCKETS, held_bytes: int = HELD_BYTES) -> DataFrame:
    """``(bucket, n)``: how many features of all texts of ``docs`` fall into each bucket that has any.

    Lines meet by a hash of their content. A line that very many texts hold comes once per task of the scan.
    """
    lines = _line_counts(docs, held_bytes).repartition(F.xxhash64("line"))
    parts = _line_features(lines, max_n, buckets, held_bytes)
    if max_n > 1:
        parts = parts.unionByName(_cross_features(docs, max_n, buckets))
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, buckets: int) -> list[int]:
    out = [0] * buckets
    for r in counts.collect():  # a row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> np.ndarray:
    """The gain of every bucket in thousandths, rounded down."""
    buckets, all_source, all_target = len(source), sum(source), sum(target)
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * float(all_source + buckets) / (float(s + 1) * float(all_target + buckets))))
            for s, t in zip(source, target, strict=True)
        ],
        np.int64,
    )


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise of a document in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(raw: np.ndarray, offsets: np.ndarray, gain: np.ndarray, max_n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text its numbers of words and features and its weight; equal lines are weighed once."""
    n_texts, folded = len(offsets) - 1, _FOLD[raw]
    starts, ends = _lines(raw, offsets)
    first, number = _distinct(folded, starts, ends)
    spans = np.zeros(len(first) + 1, np.int64)
    lengths = (ends - starts)[first]
    np.cumsum(lengths, out=spans[1:])
    words = _Words(folded[arrow_text.ragged(starts[first], lengths)], spans)
    owner = arrow_text.owners(words.counts)
    of_line = np.zeros((3, len(first)), np.int64)
    of_line[0] = np.diff(words.counts)
    for k in range(1, max_n + 1):
        runs = words.runs(k)
        of_line[1] += np.bincount(owner[runs], minlength=len(first))
        np.add.at(of_line[2], owner[runs], gain[words.buckets(runs, k, len(gain))])
    text = np.searchsorted(offsets, starts, side="right") - 1
    out = np.zeros((3, n_texts), np.int64)
    for values, sums in zip(of_line, out, strict=True):
        np.add.at(sums, text, values[number])
    if max_n > 1:
        words = _Words(folded, offsets)
        owner = arrow_text.owners(words.counts)
        for k in range(2, max_n + 1):
            runs = _cross_runs(raw, offsets, words, k)
            out[1] += np.bincount(owner[runs], minlength=n_texts)
            np.add.at(out[2], owner[runs], gain[words.buckets(runs, k, len(gain))])
    return out[0], out[1], out[2]


def scores(docs: DataFrame, gain: np.ndarray, max_n: int = 1, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` per row of ``docs``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_text.chunks(batches):
            n_words, n_features, weight = weigh(*arrow_text.buffer(part.column("text")), gain, max_n)
            score = weight + np.array([noise(seed, i) for i in part.column("doc_id").to_pylist()], np.int64)
            columns = [part.column("doc_id"), *(pa.array(c) for c in (n_words, n_features, weight, score))]
            yield pa.record_batch(columns, ["doc_id", "n_words", "n_features", "weight", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, drawn: int, eligible: int, rows_per_task: int = ROWS_PER_RANK_TASK) -> DataFrame:
    """``rows`` with ``rank``, from 1 for the highest score; null behind the first ``drawn``.

    Rows are dealt out by ranges of score, so that a task sorts one range; the numbers of rows of the ranges
    (one per task) say where each begins.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_words"), F.asc("n_features")]
    tasks = max(1, math.ceil(eligible / rows_per_task))
    dealt = materialise(rows.repartitionByRange(tasks, *order).withColumn("_part", F.spark_partition_id()))
    counts = sorted((r["_part"], r["n"]) for r in dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    before, at = {}, 0
    for part, n in counts:
        before[part], at = at, at + n
    spark = rows.sparkSession
    starts = spark.createDataFrame(list(before.items()), "_part int, _before long")
    numbered = dealt.withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    rank = F.col("_before") + F.col("_row")
    found = numbered.join(F.broadcast(starts), "_part").withColumn("rank", F.when(rank <= drawn, rank).cast("long"))
    return found.drop("_part", "_row", "_before")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 10, max_n: int = 1, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, seed: int = SEED, held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` per row of ``docs``; those with a rank are drawn.

    ``target`` has a column ``text``. Of the N documents with at least ``least_words`` words,
    ``floor(percent * N / 100)`` are drawn, ties to the smaller id.
    """
    source = _dense(feature_counts(docs, max_n, buckets, held_bytes), buckets)
    wanted = _dense(feature_counts(target, max_n, buckets, held_bytes), buckets)
    rows = materialise(scores(docs, gains(source, wanted), max_n, seed))
    long_enough = rows.where(F.col("n_words") >= least_words)
    eligible = long_enough.count()
    found = ranked(long_enough, percent * eligible // 100, eligible)
    rest = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return found.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
