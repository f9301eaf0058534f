"""Quality scores: random Fourier features of document statistics, ridge by normal equations, isotonic calibration.

1. Every text becomes some twenty statistics (shares of character classes, function words, repeats; for the
   whole text and for its worst block of 64 words). They are stored once and serve fitting and scoring.
2. Standardised statistics go through fixed random cosine waves, whose products approximate a Gaussian kernel.
3. Tasks sum up the normal equations of their rows; the sums of at most :data:`SUM_TASKS` tasks, of
   fixed size, are added and solved on the driver.
4. A fifth of the labelled rows (by a hash of ``doc_id``) is left out of the fit and calibrates its scores
   by isotonic regression.

Labelled rows beyond ``max_labelled`` are thinned by a hash of ``doc_id``; that is the only sample. Labels, language, source and
``doc_id`` are no inputs of a score. A label row with a null quality or without a document is ignored, each of
several label rows of a document counts. Without labels of both kinds every score is the share of label 1 (1.0 if
there is no label). Null and empty texts have statistics of zero and a score. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packshot.llm import arrow_text
from packshot.llm.quality_rules import ALL_WORDS
from packshot.runtime import materialise

WAVES, RIDGE, SEED, WIDTH = 256, 1.0, 7, 1.0
MAX_LABELLED = 200_000
SUM_TASKS = 32
THRESHOLD = 0.7
BLOCK = 64
SHARES = ("upper", "digit", "stop", "mark", "symbol", "high")
_CLASS = np.zeros((len(SHARES), 256), bool)
for _i, _chars in enumerate(["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "!?", "#*$%&|<>"]):
    _CLASS[_i, [ord(c) for c in _chars]] = True
_CLASS[5, 128:] = True
N_STATISTICS = 2 + 2 * (len(SHARES) + 3) + 2


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of statistics for each text."""
    n_docs = len(offsets) - 1
    out = np.zeros((n_docs, N_STATISTICS), np.float32)
    starts, ends, first = arrow_text.words(raw, offsets)
    n_words = np.diff(first)
    if not len(starts):
        return out
    low = arrow_text.LOWER[raw]
    hashes = arrow_text.span_hashes(low, starts, ends)
    common_raw, common_offsets = arrow_text.buffer(pa.array(ALL_WORDS))
    common = np.sort(arrow_text.span_hashes(common_raw, common_offsets[:-1], common_offsets[1:]))
    is_common = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
    doc = arrow_text.owners(first)
    place = np.arange(len(starts)) - first[doc]
    keyed = hashes ^ arrow_text.mix(doc.astype(np.uint64))
    seen_before = np.ones(len(starts), bool)
    seen_before[np.unique(keyed, return_index=True)[1]] = False
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (place[1:] > 0)
    size = (ends - starts).astype(np.float64)
    values = [np.add.reduceat(np.append(_CLASS[i][raw], False).astype(np.int32), _pairs(starts, ends))[::2] for i in range(len(SHARES))]
    values += [is_common * size, again * size, seen_before * size]
    block = np.flatnonzero(place % BLOCK == 0)
    has = np.flatnonzero(n_words)
    per_doc = np.array([np.add.reduceat(v.astype(np.float64), first[has]) for v in [size, *values]])
    per_block = np.array([np.add.reduceat(v.astype(np.float64), block) for v in [size, *values]])
    share = per_block[1:] / per_block[0]
    share[len(SHARES)] *= -1  # few function words are the worse
    first_block = np.searchsorted(block, first[has])
    worst = np.maximum.reduceat(share, first_block, axis=1)
    out[has, 0] = np.log1p(n_words[has])
    out[has, 1] = np.log1p(per_doc[0] / n_words[has])
    k = len(SHARES) + 3
    out[has, 2 : 2 + k] = np.sqrt(per_doc[1:] / per_doc[0]).T
    out[has, 2 + k : 2 + 2 * k] = (np.sign(worst) * np.sqrt(np.abs(worst))).T
    breaks = np.concatenate([[0], np.cumsum(raw == 0x0A)])
    out[:, -2] = np.sqrt(np.diff(breaks[offsets]) / np.maximum(n_words, 1))
    short = np.add.reduceat((size <= 3).astype(np.float64), first[has])
    out[has, -1] = short / n_words[has]
    return out


def _pairs(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(2 * len(starts), np.int64)
    out[::2], out[1::2] = starts, ends
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, statistics`` of every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_text.chunks(batches):
            rows = statistics(*arrow_text.buffer(part.column("text")))
            values = pa.array(rows.ravel(), pa.float32())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * N_STATISTICS), values)
            yield pa.record_batch([part.column("doc_id"), lists], ["doc_id", "statistics"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, statistics array<float>")


class Waves:
    """Standardisation and random cosine waves."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray) -> None:
        random = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.where(spread > 1e-6, spread, 1.0)
        self.directions = random.normal(0, WIDTH / np.sqrt(len(mean)), (len(mean), WAVES))
        self.phases = random.uniform(0, 2 * np.pi, WAVES)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.spread, -6, 6)
        waves = np.sqrt(2 / WAVES) * np.cos(x @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(rows), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS).astype(np.float64)


def _normal_equations(rows: DataFrame, waves: Waves) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((WAVES + 1, WAVES + 1)), np.zeros(WAVES + 1)
        for batch in batches:
            if batch.num_rows:
                z = waves(_matrix(batch.column("statistics")))
                left += z.T @ z
                right += z.T @ batch.column("quality").to_numpy()
        sums = np.append(left.ravel(), right)
        yield pa.record_batch([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    parts = rows.select("statistics", "quality").coalesce(SUM_TASKS).mapInArrow(run, "sums binary").collect()
    total = sum((np.frombuffer(r["sums"]) for r in parts), np.zeros((WAVES + 1) * (WAVES + 2)))
    return total[: (WAVES + 1) ** 2].reshape(WAVES + 1, WAVES + 1), total[(WAVES + 1) ** 2 :]


class Model:
    def __init__(self, waves: Waves | None, weights: np.ndarray | None, knots: np.ndarray, levels: np.ndarray) -> None:
        self.waves, self.weights, self.knots, self.levels = waves, weights, knots, levels

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.waves(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated; a thousandth of the score keeps the order of rows on one step of the calibration."""
        if self.waves is None:
            return np.full(len(rows), self.levels[0])
        raw = self.raw(rows)
        order = np.clip(raw, -1, 2) / 3 + 1 / 3
        return np.clip(0.999 * np.interp(raw, self.knots, self.levels) + 0.001 * order, 0, 1)


def fit(statistics_table: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """``labels``: ``doc_id, quality`` of the rows that may be learnt from."""
    from pyspark.ml.regression import IsotonicRegression

    wanted = labels.where("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("double").alias("quality"))
    joined = materialise(statistics_table.join(wanted, "doc_id"))
    total = joined.count()
    if total > max_labelled:
        joined = joined.where(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1 << 30)) < int(max_labelled / total * (1 << 30)))
    held = F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(5)) == 0
    kinds = joined.agg(F.avg("quality").alias("share"), F.count_distinct("quality").alias("kinds"), F.max(held).alias("both"), F.min(held).alias("all")).first()
    if kinds["kinds"] != 2 or not kinds["both"] or kinds["all"]:
        return Model(None, None, np.zeros(1), np.array([1.0 if kinds["share"] is None else kinds["share"]]))
    at = [F.col("statistics")[i].cast("double") for i in range(N_STATISTICS)]
    moments = joined.agg(*[F.avg(x) for x in at], *[F.stddev_pop(x) for x in at]).first()
    waves = Waves(np.array(moments[:N_STATISTICS]), np.array(moments[N_STATISTICS:]))
    left, right = _normal_equations(joined.where(~held), waves)
    weights = np.linalg.solve(left + RIDGE * np.eye(WAVES + 1), right)
    model = Model(waves, weights, np.zeros(1), np.zeros(1))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = model.raw(_matrix(batch.column("statistics")))
                yield pa.record_batch([pa.array(scores), batch.column("quality")], ["features", "label"])

    scored = joined.where(held).select("statistics", "quality").mapInArrow(raw, "features double, label double")
    steps = IsotonicRegression().fit(scored)
    return Model(waves, weights, steps.boundaries.toArray(), steps.predictions.toArray())


def score(statistics_table: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = model.score(_matrix(batch.column("statistics")))
                yield pa.record_batch([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return statistics_table.mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; held-out documents' labels are not learnt from."""
    table = materialise(document_statistics(docs))
    model = fit(table, labels.where(~held_out()))
    predicted = (F.col("score") >= threshold).cast("int")
    return score(table, model).select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def kept_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that score below ``threshold``; texts are scored where they are read, without a shuffle."""
    model = fit(materialise(document_statistics(docs)), labels.where(~held_out()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_text.chunks(batches):
            keep = model.score(statistics(*arrow_text.buffer(part.column("text")))) >= threshold
            yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
