"""Benchmark items inside documents, by size-partitioned MinHash and exact shingle containment.

An item is in a document when the document has at least ``percent`` per cent of the item's distinct
``k``-word shingles (letters A-Z lower-cased). A MinHash of a whole long document says nothing about a short
item, so a document is searched as segments of at most :data:`SEGMENT` shingles. A segment falls into a size
partition; each partition has one permutation and its own number of bins, at least twice the shingles of a segment, so that
most shingles are the minimum of their bin. An item has a sketch for every partition. A document and an item that share
``n / 4 - 4`` bin minima (one at least) of the item's ``n`` shingles are a candidate: with 4 in 5 of the shingles in the
document, each a minimum with a chance of 3 in 4, the chance to share fewer is below 10^-9 from :data:`SHORT` shingles on,
and a few shingles that very many items and documents have name no pair. Shorter items are candidates by any shared shingle. Only minima (and the shingles of short items) are joined; whole sets of shingles
are then looked at for candidates alone, which a second pass over the texts of candidate documents verifies exactly.

The minima, and then the shingles of candidate items and the ids of candidate documents, are put into hash filters of
at most 32 MB, whatever their number; what passes is joined, so both sides may be of any size. Minima that very many
documents hold are spread over tasks. Rows of one ``doc_id`` are one document and rows of one ``item_id`` one
item. Texts with fewer than ``k`` words, null or empty, have no shingle: such items are never found, nor are items
without an id. Other columns are ignored. Empty tables give no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packshot.llm import arrow_text, shingles
from packshot.operators.skew import find_hot, salted_join
from packshot.runtime import materialise

WORDS, PERCENT = 5, 80
SEGMENT = 256
PARTITIONS = ((64, 128), (128, 256), (256, 512))  # shingles of a segment at most, bins
SHORT = 20
LEAST_SHARE, LEAST_LESS = 4, 4
LEAST_FILTER_BITS = 1 << 26
HOT_ROWS = 1_000_000


def partition_of(n: int) -> int:
    return next(i for i, (most, _) in enumerate(PARTITIONS) if n <= most)


def minima(members: np.ndarray, bins: int) -> np.ndarray:
    """The least shingle of each bin that has one."""
    ordered = np.sort(members)
    _, first = np.unique(ordered & np.uint64(bins - 1), return_index=True)
    return ordered[first]


def item_shingles(items: DataFrame, k: int) -> DataFrame:
    """``item_id, shingle, flags, n``: bit p of ``flags`` if the shingle is a minimum in partition p's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_text.chunks(batches):
            sets = list(shingles.text_shingles(part, k, short=False))
            lengths = [len(s) for s in sets]
            values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            flags = np.zeros(len(values), np.int32)
            at = 0
            for s in sets:
                for p, (_, bins) in enumerate(PARTITIONS):
                    flags[at : at + len(s)] |= np.isin(s, minima(s, bins)).astype(np.int32) << p
                at += len(s)
            ids = part.column("item_id").take(pa.array(np.repeat(np.arange(len(sets)), lengths)))
            yield pa.record_batch([ids, pa.array(values.view(np.int64)), pa.array(flags)], ["item_id", "shingle", "flags"])

    ids = F.col("item_id").cast("long").alias("item_id")
    rows = items.select(ids, "text").mapInArrow(run, "item_id long, shingle long, flags int")
    rows = rows.groupBy("item_id", "shingle").agg(F.bit_or("flags").alias("flags"))
    return rows.join(rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")), "item_id")


def _document_ids() -> list[Column]:
    """``_id, _none``: a document's id in two columns that joins can compare."""
    doc = F.col("doc_id").cast("long")
    return [F.coalesce(doc, F.lit(0)).alias("_id"), doc.isNull().alias("_none")]


def document_minima(docs: DataFrame, known: np.ndarray, short: np.ndarray, k: int) -> DataFrame:
    """``_id, _none, shingle, flags``: shingles that pass ``known`` and are the minimum of a segment's bin, or pass ``short``.

    Bit p of ``flags``: the shingle is a minimum in partition p's sketch of a segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_text.chunks(batches):
            hashes, first = shingles.word_hashes(part)
            grams, whole = arrow_text.grams(hashes, first, k)
            hits = np.flatnonzero(whole & shingles.in_filter(known, grams)) if len(grams) else np.zeros(0, np.int64)
            text = np.searchsorted(first, hits, side="right") - 1
            start = first[text]
            low = start + (hits - start) // SEGMENT * SEGMENT
            high = np.minimum(low + SEGMENT, first[text + 1] - k + 1)
            flags = np.zeros(len(hits), np.int32)
            for i, (h, a, b) in enumerate(zip(hits.tolist(), low.tolist(), high.tolist(), strict=True)):
                p = partition_of(b - a)
                segment, mask = grams[a:b], np.uint64(PARTITIONS[p][1] - 1)
                flags[i] = int(segment[(segment & mask) == (grams[h] & mask)].min() == grams[h]) << p
            use = (flags > 0) | shingles.in_filter(short, grams[hits]) if len(hits) else np.zeros(0, bool)
            ids = part.select(["_id", "_none"]).take(pa.array(text[use]))
            yield pa.record_batch([*ids.columns, pa.array(grams[hits[use]].view(np.int64)), pa.array(flags[use])], ["_id", "_none", "shingle", "flags"])

    rows = docs.select(*_document_ids(), "text").mapInArrow(run, "_id long, _none boolean, shingle long, flags int")
    return rows.groupBy("_id", "_none", "shingle").agg(F.bit_or("flags").alias("flags"))


def candidate_pairs(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``_id, _none, item_id`` of the documents and items that share enough bin minima (or any shingle of a short item)."""
    is_short = F.col("n") < SHORT
    sketched = wanted.where(is_short | (F.col("flags") > 0))
    bits = shingles.filter_bits(sketched.count(), LEAST_FILTER_BITS)
    known, short = (shingles.hash_filter(x, F.col("shingle"), bits) for x in (sketched, sketched.where(is_short)))
    minima_of_docs = materialise(document_minima(docs, known, short, k))
    items = sketched.select("item_id", "shingle", "n", F.col("flags").alias("item_flags"))
    hot = find_hot(minima_of_docs, ["shingle"], rows=HOT_ROWS)
    both = salted_join(minima_of_docs, items, ["shingle"], hot, F.xxhash64("_id", "_none"))
    shared = is_short | (F.col("flags").bitwiseAND(F.col("item_flags")) > 0)
    met = both.where(shared).groupBy("_id", "_none", "item_id").agg(F.count(F.lit(1)).alias("_m"), F.max("n").alias("n"))
    return met.where(F.col("_m") >= F.greatest(F.lit(1), F.expr(f"n div {LEAST_SHARE} - {LEAST_LESS}"))).drop("_m", "n")


def candidate_shingles(docs: DataFrame, pairs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``_id, _none, shingle`` of candidate documents, as far as candidate items have the shingle: a pass over their texts."""
    ids, items = pairs.select("_id").distinct(), wanted.join(pairs.select("item_id").distinct(), "item_id", "left_semi")
    known_ids = shingles.hash_filter(ids, F.xxhash64("_id"), shingles.filter_bits(ids.count()))
    known = shingles.hash_filter(items, F.col("shingle"), shingles.filter_bits(items.count(), LEAST_FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(shingles.in_filter(known_ids, batch.column("_key").to_numpy())))
            for part in arrow_text.chunks([some]):
                hashes, first = shingles.word_hashes(part)
                grams, whole = arrow_text.grams(hashes, first, k)
                hits = np.flatnonzero(whole & shingles.in_filter(known, grams)) if len(grams) else np.zeros(0, np.int64)
                found = part.select(["_id", "_none"]).take(pa.array(np.searchsorted(first, hits, side="right") - 1))
                yield pa.record_batch([*found.columns, pa.array(grams[hits].view(np.int64))], ["_id", "_none", "shingle"])

    source = docs.select(*_document_ids(), "text").withColumn("_key", F.xxhash64("_id"))
    return source.mapInArrow(run, "_id long, _none boolean, shingle long").distinct()


def contained_items(docs: DataFrame, items: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, item_id, n_shared, n_shingles`` of every item found in a document."""
    wanted = materialise(item_shingles(items, k))
    pairs = materialise(candidate_pairs(docs, wanted, k))
    asked = pairs.join(wanted.select("item_id", "shingle", "n"), "item_id")
    both = asked.join(candidate_shingles(docs, pairs, wanted, k), ["_id", "_none", "shingle"])
    shared = both.groupBy("_id", "_none", "item_id").agg(F.count(F.lit(1)).alias("n_shared"), F.max("n").alias("n_shingles"))
    found = shared.where(100 * F.col("n_shared") >= percent * F.col("n_shingles"))
    return found.select(F.when(~F.col("_none"), F.col("_id")).alias("doc_id"), "item_id", "n_shared", "n_shingles")


def without_contaminated(docs: DataFrame, items: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that an item was found in."""
    found = materialise(contained_items(docs, items, k, percent).select(F.col("doc_id").alias("_leaked")).distinct())
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["_leaked"]), "left_anti")
