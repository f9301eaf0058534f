"""Passages of ``window`` words that an earlier document has too, by full-text indexes per shard.

Each window is filed under its anchor, the least hash of its runs of :data:`GRAM` words, so equal windows have
equal anchors. Neighbouring windows with one anchor are a run. Runs under an anchor that only one document
has are not repeated and go no further (a hash filter of at most 32 MB; a false hit only costs work).
The different runs that are left, each with the least document that has it, are dealt out by anchor to
shards. A shard builds an FM-index of its runs (:mod:`packshot.llm.fm_index`), streams the runs through it
and reports, for each window that matches in full length, the least document among all its places. An anchor with more
than a shard's words is cut into blocks: each block is an index and each streams through each.

A window of a document is repeated if the least document found is smaller; intervals of repeated windows are
gathered per document, and the words they cover are removed. What is repeated is judged on the input.

Words are 64-bit hashes. Null texts have no words. Rows that repeat a ``doc_id`` are judged one by one: none is
smaller than the other. A row with a null ``doc_id`` keeps all its words and is no source. Extra columns are ignored.
An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packshot.llm import arrow_text, shingles
from packshot.llm.fm_index import DEPTH, FMIndex
from packshot.runtime import materialise

WINDOW, GRAM = 50, 8
RUN = 64  # windows of a run at most
SHARD_WORDS = 1_000_000
RUNS = "anchor long, run long, doc_id long, row_key long, start long, n_windows int, words binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _least_in_reach(values: np.ndarray, reach: int) -> np.ndarray:
    """The least of ``reach`` values from each place on."""
    out, have = values, 1
    while 2 * have <= reach:
        out, have = np.minimum(out[: len(out) - have], out[have:]), 2 * have
    return np.minimum(out[: len(values) - reach + 1], out[reach - have : reach - have + len(values) - reach + 1])


def window_runs(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows in the texts of a batch: ``text, first word, number of windows, anchor, hash of the run``."""
    grams, _ = arrow_text.grams(hashes, first, GRAM)
    none = np.zeros(0, np.int64)
    n = len(hashes) - window + 1
    if n < 1:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    anchors = _least_in_reach(grams, window - GRAM + 1)[:n]
    text = arrow_text.owners(first)
    place = np.arange(n)
    valid = place + window <= first[text[:n] + 1]
    new = np.ones(n, bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (text[1:n] != text[: n - 1])
    since = place - np.maximum.accumulate(np.where(new, place, 0))
    new |= since % RUN == 0
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, n))
    keep = valid[starts]
    # windows of a text are valid up to one of them, so a run is cut there
    last = np.minimum(starts + lengths, first[text[starts] + 1] - window + 1)
    starts, lengths = starts[keep], (last - starts)[keep]
    ends = starts + lengths + window - 1
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * arrow_text.powers(len(hashes)), out=sums[1:])
    runs = arrow_text.mix((sums[ends] - sums[starts]) * arrow_text.powers(len(hashes), inverse=True)[starts] + lengths.astype(np.uint64))
    return text[starts], starts, lengths, anchors[starts], runs


def _run_rows(docs: DataFrame, window: int, kept, with_words: bool, columns: list[str]) -> DataFrame:
    """Rows of :data:`RUNS`; ``kept(anchor, run, doc_id)`` tells which runs of a batch are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_text.chunks(batches):
            hashes, first = shingles.word_hashes(part, lower=False)
            text, starts, lengths, anchors, runs = window_runs(hashes, first, window)
            ids = part.column("doc_id").to_numpy()
            keep = kept(anchors.view(np.int64), runs.view(np.int64), ids[text])
            text, starts, lengths, anchors, runs = (x[keep] for x in (text, starts, lengths, anchors, runs))
            words = []
            if with_words:
                words = [hashes[a : a + n + window - 1].tobytes() for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
            values = {
                "anchor": pa.array(anchors.view(np.int64)),
                "run": pa.array(runs.view(np.int64)),
                "doc_id": pa.array(ids[text]),
                "row_key": part.column("row_key").take(pa.array(text)),
                "start": pa.array(starts - first[text]),
                "n_windows": pa.array(lengths.astype(np.int32)),
                "words": pa.array(words, pa.binary()) if with_words else None,
            }
            yield pa.record_batch([values[c] for c in columns], columns)

    kinds = dict(x.split() for x in RUNS.split(", "))
    return docs.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))


def _searched(window: int):
    """A task: the windows of streamed runs with the least document that has them."""

    def run(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()]
        indexed = np.flatnonzero(table.column("indexed").to_numpy())
        streamed = np.flatnonzero(table.column("streamed").to_numpy())
        least = table.column("least").to_numpy()
        sizes = np.array([len(w) for w in words], np.int64)
        names = ["anchor", "run", "from", "to", "least"]
        if not len(indexed) or not len(streamed):
            return pa.table([pa.array([], pa.int64())] * 5, names)
        known, ids = np.unique(np.concatenate([words[i] for i in indexed]), return_inverse=True)
        lengths = sizes[indexed]
        ends = np.cumsum(lengths + 1) - 1  # a separator behind each run
        text = np.zeros(int(ends[-1]) + 1, np.int64)
        held = np.ones(len(text), bool)
        held[ends] = False
        text[held] = ids + 1
        index = FMIndex(text, len(known) + 1, window)
        source = np.repeat(least[indexed], lengths + 1)[index.order]
        starts = np.flatnonzero(index.common < window)
        interval_least = np.minimum.reduceat(source, starts)
        pattern = np.concatenate([words[i] for i in streamed])
        at = np.searchsorted(known, pattern).clip(0, len(known) - 1)
        pattern = np.where(known[at] == pattern, at + 1, 0)
        stops = np.cumsum(sizes[streamed])
        begins = stops - sizes[streamed]
        place, low = index.windows(pattern, begins, stops)
        if not len(place):
            return pa.table([pa.array([], pa.int64())] * 5, names)
        found = interval_least[np.searchsorted(starts, low, side="right") - 1]
        order = np.argsort(place)
        place, found = place[order], found[order]
        owner = np.searchsorted(stops, place, side="right")
        # neighbours with one answer are one interval
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1] + 1) | (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place)) - 1
        rows = streamed[owner[first]]
        columns = [table.column(c).to_numpy()[rows] for c in ("anchor", "run")]
        columns += [place[first] - begins[owner[first]], place[last] - begins[owner[first]], found[first]]
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], names)

    return run


def least_sources(different: DataFrame, window: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``anchor, run, from, to, least``: windows of each run that the shards hold, with the least document that has them.

    ``different``: stored rows ``anchor, run, least, words``, one per run.
    """
    n_words = F.length("words") / 8
    total = different.agg(F.coalesce(F.sum(n_words), F.lit(0))).first()[0]
    shards = max(1, int(-(-total // shard_words)))
    per_anchor = different.groupBy("anchor").agg(F.ceil(F.sum(n_words) / shard_words).cast("int").alias("blocks"))
    hot = materialise(per_anchor.where("blocks > 1"))
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    rows = different.join(hot, "anchor", "left").withColumn("own", F.pmod(F.xxhash64("run"), F.coalesce("blocks", F.lit(1))))
    yes, no = F.lit(True), F.lit(False)
    usual = rows.where("blocks is null").select("anchor", "run", "least", "words", shard.alias("s"), F.lit(0).alias("x"), F.lit(0).alias("y"), yes.alias("indexed"), yes.alias("streamed"))
    crowded = rows.where("blocks is not null").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own, k = F.col("own").cast("int"), F.col("k")
    common = ["anchor", "run", "least", "words", F.col("anchor").alias("s")]
    as_index = crowded.select(*common, own.alias("x"), k.alias("y"), yes.alias("indexed"), (own == k).alias("streamed"))
    as_stream = crowded.where(own != k).select(*common, k.alias("x"), own.alias("y"), no.alias("indexed"), yes.alias("streamed"))
    dealt = usual.unionByName(as_index).unionByName(as_stream)
    return dealt.groupBy("s", "x", "y").applyInArrow(_searched(window), "anchor long, run long, from long, to long, least long")


def repeated_intervals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, row_key, first, last``: words covered by windows that a smaller document has. ``docs``: see :func:`_keyed`."""
    if not GRAM < window <= DEPTH:
        raise ValueError(f"a window has {GRAM + 1} to {DEPTH} words")
    docs = docs.where("doc_id is not null")
    every = lambda anchor, run, doc: np.ones(len(anchor), bool)
    anchors = _run_rows(docs, window, every, False, ["anchor", "doc_id"]).groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    repeated = materialise(anchors.where("a < b").select("anchor"))
    known = shingles.hash_filter(repeated, F.col("anchor"), shingles.filter_bits(repeated.count()))
    wanted = lambda anchor, run, doc: shingles.in_filter(known, anchor)
    runs = materialise(_run_rows(docs, window, wanted, False, ["anchor", "run", "doc_id", "row_key", "start", "n_windows"]))
    least = materialise(runs.groupBy("anchor", "run").agg(F.min("doc_id").alias("least")))
    holders = shingles.hash_filter(least, F.col("run").bitwiseXOR(F.col("least")), shingles.filter_bits(least.count()))

    def first_holder(anchor: np.ndarray, run: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return shingles.in_filter(known, anchor) & shingles.in_filter(holders, run ^ doc)

    texts = _run_rows(docs, window, first_holder, True, ["anchor", "run", "doc_id", "words"])
    # a passage may stand in its first document more than once, and the filter may let others through
    texts = texts.withColumnRenamed("doc_id", "least").join(least, ["anchor", "run", "least"])
    different = materialise(texts.dropDuplicates(["anchor", "run"]))
    found = materialise(least_sources(different, window))
    places = runs.join(found, ["anchor", "run"]).where("least < doc_id")
    return places.select(
        "doc_id",
        "row_key",
        (F.col("start") + F.col("from")).alias("first"),
        (F.col("start") + F.col("to") + window - 1).alias("last"),
    )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("row_key"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text, n_words, n_removed`` with the kept words joined by single spaces as ``text``."""
    return _cut(docs, window, False)


def repeat_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``: as :func:`without_repeats`, with a digest of the kept text."""
    return _cut(docs, window, True)


def _cut(docs: DataFrame, window: int, digest: bool) -> DataFrame:
    keyed = _keyed(docs)
    covered = repeated_intervals(keyed, window).groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("first", "last")).alias("covered"))
    # the kept text needs the document: one shuffle of the texts
    joined = keyed.join(materialise(covered), ["doc_id", "row_key"], "left").select("doc_id", "text", "covered")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_text.chunks(batches):
            raw, offsets = arrow_text.buffer(part.column("text"))
            data, rows = raw.tobytes(), []
            for a, b, spans in zip(offsets[:-1].tolist(), offsets[1:].tolist(), part.column("covered"), strict=True):
                words = data[a:b].split()
                kept = words
                if spans.is_valid and len(words):
                    steps = np.zeros(len(words) + 1, np.int32)
                    values = spans.values
                    np.add.at(steps, values.field("first").to_numpy(), 1)
                    np.add.at(steps, values.field("last").to_numpy() + 1, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
                text = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest() if digest else text.decode()))
            n, removed, text = zip(*rows, strict=True)
            columns = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(text, pa.string())]
            yield pa.record_batch(columns, names)

    kinds = RESULT if digest else RESULT.replace("kept_sha256", "text")
    names = [x.split()[0] for x in kinds.split(", ")]
    return joined.mapInArrow(run, kinds)
