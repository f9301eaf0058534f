"""Log probabilities of texts by a probabilistic suffix tree over words.

Tokens are words (letters A-Z lower-cased) and one end per document; every word is a symbol of its own. A context is a
sequence of up to ``depth`` tokens before a token; the start of the document counts as one.

*Contexts.* A context that occurs ``least_context`` times in the training texts is a candidate, and a token that follows it
``least_pair`` times is stored behind it; both are plain counts, so the tree grows with the corpus. Level by level, a
candidate is retained if the context without its first token is, and if its distribution diverges from that one's: by
``divergence`` nats or more, and by ``gain`` nats in all for each token stored behind it.

*Smoothing.* Behind a context s, ``P(x|s) = (c(sx) + (rest(s) + beta) P(x|suffix of s)) / (c(s) + beta)``, where
``rest(s)`` is what the tokens that are not stored add up to. Behind the empty context it is ``(c(x) + 1) / (N + V + 1)``. Every
distribution adds up to 1.

*Scoring.* Each token takes the longest retained suffix of what stands before it. Its log probability is that behind the empty
context, plus ``log w(s)`` for each retained suffix s, ``w(s) = (rest(s) + beta) / (c(s) + beta)``, plus for each that stores the token
``log P(x|s) - log P(x|suffix of s) - log w(s)``. So a text's score is a sum over its runs of up to ``depth + 1`` tokens
of one weight per run, and the tree is a table of run hashes and weights.

All counts cover all training documents, and no part of the tree is bounded by a share of them. Runs that make up at
least ``HEAD`` of the tokens, fewer than ``1 / HEAD`` per length, go to the tasks; they would be hot keys. All others meet the
documents in shards of their hash, one packed row per shard and batch of documents; a packed row of sums comes back
for each. Hash filters of bounded size leave out what is in no shard.

Null and empty texts are one end token. Every row is scored; repeated rows come back as often as they are there. A null
``doc_id`` is trained on like any other. Extra columns are ignored. Without training documents the model is the
uniform one over one unseen word. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packshot.llm import arrow_text, shingles
from packshot.runtime import materialise, release_shuffles, remove_table

DEPTH, LEAST_CONTEXT, LEAST_PAIR = 4, 32, 6
DIVERGENCE, GAIN, BETA = 0.01, 2.0, 10.0
FOLDS, HELD_FOLD = 7, 2
HEAD = 5e-7
BATCH_BYTES = 16 << 20
SHARD_TOKENS, SHARD_RUNS = 8_000_000, 500_000
BLOCK = 1 << 16  # places of a filter that are counted together
END = np.uint64(0x243F6A8885A308D3)  # the hashes that stand for the end token and the start
START = np.uint64(0x13198A2E03707344)
_STEP = np.uint64(0xD1342543DE82EF95)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_FOLD, F.lit(False))


def _stream(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens with a start before and an end behind each text, and where each text starts (with the end of the last)."""
    hashes, first = shingles.word_hashes(part)
    n = np.diff(first)
    out = np.full(len(hashes) + 2 * len(n), END, np.uint64)
    cuts = np.concatenate([[0], np.cumsum(n + 2)])
    own = np.ones(len(out), bool)
    own[cuts[:-1]] = own[cuts[1:] - 1] = False
    out[own] = hashes
    out[cuts[:-1]] = START
    return out, cuts


def _places(cuts: np.ndarray) -> np.ndarray:
    return np.arange(cuts[-1]) - np.repeat(cuts[:-1], np.diff(cuts))


def joined(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The hash of a run from those of the run without its last and without its first token."""
    return arrow_text.mix(prefix * _STEP + suffix)


def _longer(runs: np.ndarray) -> np.ndarray:
    """Hashes of the runs that are one token longer, each at its last token; the first one has no meaning."""
    out = np.zeros_like(runs)
    out[1:] = joined(runs[:-1], runs[1:])
    return out


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers as the planes of their bytes, as many as the largest one needs, compressed."""
    wide = numbers.astype("<u8")
    width = max(1, (int(wide.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(wide.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return len(wide).to_bytes(7, "little") + bytes([width]) + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(raw: bytes) -> np.ndarray:
    n, width = int.from_bytes(raw[:7], "little"), raw[7]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(raw[8:], n * width, "zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def packed_rising(numbers: np.ndarray) -> bytes:
    """As :func:`packed`, for numbers in ascending order: the first, and the steps."""
    return numbers[:1].astype("<u8").tobytes() + packed(np.diff(numbers)) if len(numbers) else b""


def unpacked_rising(raw: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate([np.frombuffer(raw[:8], "<u8"), unpacked(raw[8:])]), dtype=np.uint64) if raw else np.zeros(0, np.uint64)


def _merged(rows: Iterator[tuple[np.ndarray, ...]], count, limit: int = BATCH_BYTES // 6) -> Iterator[pa.RecordBatch]:
    """``count`` of the rows put together, whenever there are ``limit`` of them."""
    held: list[tuple] = []
    n = 0
    for row in rows:
        held.append(row)
        n += len(row[0])
        if n >= limit:
            yield count(*map(np.concatenate, zip(*held, strict=True)))
            held, n = [], 0
    if n:
        yield count(*map(np.concatenate, zip(*held, strict=True)))


def word_counts(docs: DataFrame) -> DataFrame:
    """``run, n``: how often each token hash occurs in training documents (``held`` false)."""

    def count(tokens: np.ndarray) -> pa.RecordBatch:
        words, n = np.unique(tokens, return_counts=True)
        return pa.record_batch([pa.array(words.view(np.int64)), pa.array(n)], ["run", "n"])

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray]]:
        for part in arrow_text.chunks(batches):
            stream, cuts = _stream(part)
            yield (np.delete(stream, cuts[:-1]),)

    rows = docs.where("not held").select("text").mapInArrow(lambda batches: _merged(tokens(batches), count), "run long, n long")
    return rows.groupBy("run").agg(F.sum("n").alias("n"))


class Known:
    """Filters of the runs that may be contexts and of those that may be stored, one token shorter than what is counted."""

    def __init__(self, counts: DataFrame, least_context: int, least_pair: int) -> None:
        def of(least: int) -> np.ndarray:
            rows = counts.where(F.col("n") >= least)
            return shingles.hash_filter(rows, F.col("run"), shingles.filter_bits(rows.count()))

        self.contexts, self.pairs = of(least_context), of(least_pair)

    def among(self, runs: np.ndarray, ok: np.ndarray) -> np.ndarray:
        """Of the longer runs at ``ok``, those whose halves are both known."""
        at = np.flatnonzero(ok)
        at = at[(runs[at - 1] == START) | shingles.in_filter(self.contexts, runs[at - 1])]
        at = at[shingles.in_filter(self.pairs, runs[at])]
        out = np.zeros(len(ok), bool)
        out[at] = True
        return out


def _candidates(batches: Iterator[pa.RecordBatch], known: Known, least: int, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For lengths ``least`` to ``most``: the length, all runs one token shorter, all runs, and the places of the candidates."""
    for part in arrow_text.chunks(batches):
        runs, cuts = _stream(part)
        place = _places(cuts)
        ok = None
        for n in range(2, most + 1):
            shorter, runs = runs, _longer(runs)
            if n < least:
                continue
            if ok is None:
                ok = known.among(shorter, place >= n - 1)
            else:
                ok[1:] &= ok[:-1] & (place[1:] >= n - 1)
                ok[0] = False
            yield n, shorter, runs, np.flatnonzero(ok)


def repeated_filter(docs: DataFrame, known: Known, length: int, bits: int, least_pair: int) -> np.ndarray:
    """A filter of the runs of ``length`` tokens that may occur ``least_pair`` times: the places of a filter are counted.

    Places move in blocks, two bytes for the place in the block and one or more for the count. The driver gets ``bits / 8`` bytes.
    """
    place, number = np.dtype("<u2"), np.min_scalar_type(least_pair)

    def count(at: np.ndarray) -> pa.RecordBatch:
        at, n = np.unique(at, return_counts=True)
        blocks, starts = np.unique(at // BLOCK, return_index=True)
        ends = np.append(starts, len(at)).astype(np.int32)

        def rows(values: np.ndarray) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(blocks), [None, pa.py_buffer(ends * np.int32(values.itemsize)), pa.py_buffer(values.tobytes())])

        columns = [pa.array(blocks.astype(np.int32)), rows((at % BLOCK).astype(place)), rows(n.clip(0, least_pair).astype(number))]
        return pa.record_batch(columns, ["block", "at", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (((runs[at] & np.uint64(bits - 1)).astype(np.int32),) for _, _, runs, at in _candidates(batches, known, length, length))
        return _merged(rows, count, BATCH_BYTES // 8)

    def often(parts: pa.Table) -> pa.Table:
        n = np.zeros(BLOCK, np.int64)
        for at, more in zip(parts.column("at"), parts.column("n"), strict=True):  # no place is twice in a row
            n[np.frombuffer(at.as_buffer(), place)] += np.frombuffer(more.as_buffer(), number)
        return pa.table({"block": parts.column("block")[:1], "map": [np.packbits(n >= least_pair, bitorder="little").tobytes()]})

    rows = docs.where("not held").select("text").mapInArrow(run, "block int, at binary, n binary")
    out = np.zeros((bits // BLOCK, BLOCK // 8), np.uint8)
    for row in rows.groupBy("block").applyInArrow(often, "block int, map binary").toLocalIterator():
        out[row["block"]] = np.frombuffer(row["map"], np.uint8)
    return out.ravel()


def _named(rows: DataFrame, columns: str) -> DataFrame:
    """``rows`` with the ``run`` that each ``context`` and ``suffix`` make."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("context", "suffix"))
            yield pa.record_batch([*batch.columns, pa.array(joined(*halves).view(np.int64))], [*batch.schema.names, "run"])

    return rows.mapInArrow(name, f"{columns}, run long")


def run_counts(
    docs: DataFrame, known: Known, least: int, most: int, least_pair: int, repeated: np.ndarray | None = None, n_shards: int = 1
) -> DataFrame:
    """``length, context, suffix, n, run`` of the runs of ``least`` to ``most`` tokens that occur ``least_pair`` times behind a candidate.

    What a batch counts moves in a packed row per shard of the runs' hashes: contexts once, in ascending order.
    """
    kinds = ["length", "contexts", "kinds", "suffix", "n"]

    def count(length: np.ndarray, context: np.ndarray, suffix: np.ndarray, runs: np.ndarray) -> pa.RecordBatch:
        runs, at, n = np.unique(runs, return_index=True, return_counts=True)
        shard = (runs >> np.uint64(32)) * np.uint64(n_shards) >> np.uint64(32)
        order = np.lexsort((context[at], shard))
        at, n, shard = at[order], n[order], shard[order]
        length, context, suffix = length[at], context[at], suffix[at]
        shards, cuts = np.unique(shard, return_index=True)
        rows = []
        for a, b in zip(cuts, [*cuts[1:], len(at)], strict=True):
            contexts, each = np.unique(context[a:b], return_counts=True)
            rows.append((packed(length[a:b]), packed_rising(contexts), packed(each), suffix[a:b].tobytes(), packed(n[a:b])))
        columns = [pa.array(shards.astype(np.int32)), *(pa.array(list(c), pa.binary()) for c in zip(*rows, strict=True))]
        return pa.record_batch(columns, ["shard", *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[np.ndarray, ...]]:
            for length, shorter, runs, at in _candidates(batches, known, least, most):
                if repeated is not None:
                    at = at[shingles.in_filter(repeated, runs[at])]
                if len(at):
                    yield np.full(len(at), length, np.uint8), shorter[at - 1], shorter[at], runs[at]

        return _merged(rows(), count, BATCH_BYTES // 16)

    def add(parts: pa.Table) -> pa.Table:
        rows = list(zip(*(parts.column(c).to_pylist() for c in kinds), strict=True))
        length = np.concatenate([unpacked(r[0]).astype(np.int32) for r in rows])
        context = np.concatenate([np.repeat(unpacked_rising(r[1]), unpacked(r[2]).astype(np.int64)) for r in rows])
        suffix = np.concatenate([np.frombuffer(r[3], np.uint64) for r in rows])
        runs, at, whose = np.unique(joined(context, suffix), return_index=True, return_inverse=True)
        n = np.bincount(whose, np.concatenate([unpacked(r[4]) for r in rows])).astype(np.int64)
        often = n >= least_pair
        at = at[often]
        columns = [length[at], context[at].view(np.int64), suffix[at].view(np.int64), n[often], runs[often].view(np.int64)]
        return pa.table(columns, ["length", "context", "suffix", "n", "run"])

    binaries = ", ".join(f"{c} binary" for c in kinds)
    rows = docs.where("not held").select("text").mapInArrow(run, f"shard int, {binaries}")
    return rows.groupBy("shard").applyInArrow(add, "length int, context long, suffix long, n long, run long")


def _named(rows: DataFrame, columns: str) -> DataFrame:
    """``rows`` with the ``run`` that each ``context`` and ``suffix`` make."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("context", "suffix"))
            yield pa.record_batch([*batch.columns, pa.array(joined(*halves).view(np.int64))], [*batch.schema.names, "run"])

    return rows.mapInArrow(name, f"{columns}, run long")


def _level(counts: DataFrame, totals: DataFrame, shorter: DataFrame, least_context: int) -> tuple[DataFrame, DataFrame]:
    """The contexts of a level that are retained (``run, n, weight``), and what they store (``run, n, p, delta``).

    ``totals``: ``run, n`` of the contexts; ``shorter``: ``run, p`` stored behind their suffixes.
    """
    contexts = totals.where(F.col("n") >= least_context).select(F.col("run").alias("context"), F.col("n").alias("total"))
    before = shorter.select(F.col("run").alias("suffix"), F.col("p").alias("before"))
    pairs = counts.select("context", "suffix", "n").join(before, "suffix").join(contexts, "context")
    behind = Window.partitionBy("context")
    rest = F.col("total") - F.col("seen")
    of_rest = F.when(rest > 0, rest * F.ln(rest / F.col("total") / F.greatest(1 - F.col("expected"), F.lit(1e-12)))).otherwise(0.0)
    retained = (
        pairs.withColumns(
            {
                "seen": F.sum("n").over(behind),
                "expected": F.sum("before").over(behind),
                "gain": F.sum(F.col("n") * F.ln(F.col("n") / F.col("total") / F.col("before"))).over(behind),
                "kinds": F.count(F.lit(1)).over(behind),
                "first": F.min("suffix").over(behind),
            }
        )
        .withColumn("gain", F.col("gain") + of_rest)
        .where((F.col("gain") >= DIVERGENCE * F.col("total")) & (F.col("gain") >= GAIN * F.col("kinds")))
        .withColumn("weight", (rest + BETA) / (F.col("total") + BETA))
        .withColumn("p", F.col("n") / (F.col("total") + BETA) + F.col("weight") * F.col("before"))
        .withColumn("delta", F.log10("p") - F.log10("before") - F.log10("weight"))
        .withColumn("one", F.col("suffix") == F.col("first"))  # a row of the context
        .select("context", "suffix", "n", "p", "delta", "one", *(F.when(F.col("one"), F.col(c)).alias(c) for c in ("total", "weight")))
    )
    rows = materialise(_named(retained, "context long, suffix long, n long, p double, delta double, one boolean, total long, weight double").drop("suffix"))
    return rows.where("one").select(F.col("context").alias("run"), F.col("total").alias("n"), "weight"), rows.select("run", "n", "p", "delta")


def weights(docs: DataFrame, words: DataFrame, total: int, distinct: int, depth: int = DEPTH, least_context: int = LEAST_CONTEXT, least_pair: int = LEAST_PAIR) -> DataFrame:
    """``run, seen, n, weight``: what each run adds to a score, maybe in two rows. ``seen``: how often it occurs; ``n``: the same for words, else 0.

    A word adds ``log10(n + 1)``, on top of the log probability of an unseen word.
    """
    spark = docs.sparkSession
    n_texts = docs.where("not held").count()
    totals = words.select("run", "n").where(F.col("run") != int(END.view(np.int64))).union(spark.createDataFrame([(int(START), n_texts)], "run long, n long"))
    # a run is seen no more often than what it ends with
    shorter = words.where(F.col("n") >= least_pair).select("run", ((F.col("n") + 1) / (total + distinct + 1)).alias("p"))
    out = words.select("run", F.col("n").alias("seen"), "n", F.log10(F.col("n") + 1).alias("weight"))
    known = Known(words, least_context, least_pair)
    bits, n_shards = shingles.filter_bits(total), 1 + total * 2 // SHARD_TOKENS
    lengths = iter(range(2, depth + 2))
    counts, stored_tables = None, []
    for length in lengths:
        if length <= 4:  # the few longer ones are counted in the same pass
            most = length if length < 4 else depth + 1
            repeated = repeated_filter(docs, known, length, bits, least_pair) if length < 4 else None
            counts = materialise(run_counts(docs, known, length, most, least_pair, repeated, n_shards))
            stored_tables.append(counts)
        level = counts.where(F.col("length") == length)
        retained, stored = _level(level, totals, shorter, least_context)
        add = F.lit(0).cast("long").alias("n")
        stored_tables.append(stored)
        release_shuffles(spark)
        out = out.union(stored.select("run", F.col("n").alias("seen"), add, F.col("delta").alias("weight")))
        out = out.union(retained.select("run", F.col("n").alias("seen"), add, F.log10("weight").alias("weight")))
        totals, shorter = level.select("run", "n"), stored.select("run", "p")
        if length < 4:
            known = Known(level, least_context, least_pair)
    out = materialise(out)
    for table in stored_tables:
        remove_table(table)
    return out


class Head:
    """The runs that many documents hold, and a filter of these and all others."""

    def __init__(self, often: DataFrame, table: DataFrame, n: int) -> None:
        often = often.groupBy("run").agg(F.max("n").alias("n"), F.sum("weight").alias("weight"))
        rows = often.toArrow()
        runs = rows.column("run").to_numpy().view(np.uint64)
        order = np.argsort(runs)
        self.runs = runs[order]
        self.n = rows.column("n").to_numpy()[order]
        self.weights = rows.column("weight").to_numpy()[order]
        self.bits = np.uint64(max(1, len(self.runs).bit_length()))
        self.first = np.searchsorted(self.runs >> (np.uint64(64) - self.bits), np.arange(1 << int(self.bits), dtype=np.uint64)).astype(np.int32)
        self.filter = shingles.hash_filter(table, F.col("run"), shingles.filter_bits(n))

    def find(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each run in the head, and whether it is there."""
        if not len(self.runs):
            return np.zeros(len(runs), np.int64), np.zeros(len(runs), bool)
        at = self.first[runs >> (np.uint64(64) - self.bits)].clip(0, len(self.runs) - 1)
        left = np.flatnonzero(self.runs[at] < runs)
        while len(left):  # a few steps, as the head's hashes are evenly dealt
            left = left[at[left] < len(self.runs) - 1]
            at[left] += 1
            left = left[self.runs[at[left]] < runs[left]]
        return at, self.runs[at] == runs


def _runs(runs: np.ndarray, cuts: np.ndarray, depth: int, table: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: the length, hashes of the runs in the texts of a stream that may be in the table, and their texts.

    The start alone is no run. A run is in the table only if it is there without its first token.
    """
    text = arrow_text.owners(cuts)
    at = np.flatnonzero(_places(cuts) >= 1)
    for n in range(1, depth + 2):
        if n > 1:
            runs = _longer(runs)
            at = at[at - cuts[text[at]] >= n - 1]
        at = at[shingles.in_filter(table, runs[at])]
        yield n, runs[at], text[at]


def row_keys(part: pa.RecordBatch, stream: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A hash of each row's id and tokens: rows that share it have the same scores."""
    ids = part.column("doc_id")
    keys = ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) * np.uint64(2) + ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint64)
    return arrow_text.mix(arrow_text.mix(keys) + np.add.reduceat(arrow_text.mix(stream + _places(cuts).astype(np.uint64)), cuts[:-1]))


ROW = np.dtype([("key", "u8"), ("doc_id", "i8"), ("no_id", "?"), ("held", "?"), ("n_tokens", "i8"), ("n_known", "i8"), ("base", "f8"), ("score", "f8")])


def _own_sums(part: pa.RecordBatch, depth: int, head: Head, start: float, unseen: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A ``ROW`` per document, with its tokens and what the head adds to its sums; the runs left to ask for, and their documents."""
    size = part.num_rows
    out = np.zeros(size, ROW)
    stream, cuts = _stream(part)
    ids = part.column("doc_id")
    out["key"], out["no_id"] = row_keys(part, stream, cuts), ids.is_null().to_numpy(zero_copy_only=False)
    out["doc_id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out["held"] = part.column("held").to_numpy(zero_copy_only=False)
    out["n_tokens"] = np.diff(cuts) - 1
    out["score"] = start + out["n_tokens"] * unseen
    left = []
    for length, hashes, text in _runs(stream, cuts, depth, head.filter):
        at, found = head.find(hashes)
        left.append((hashes[~found], text[~found].astype(np.int32)))
        at, whose = at[found], text[found]
        out["score"] += np.bincount(whose, head.weights[at], size)
        if length == 1:
            out["n_known"] = np.bincount(whose, minlength=size)
            out["base"] = out["n_tokens"] * unseen + np.bincount(whose, np.log10(head.n[at] + 1), size)
    return out, *(np.concatenate(x) for x in zip(*left, strict=True))


def _sums(docs: DataFrame, head: Head, tail: DataFrame, depth: int, n_shards: int, start: float, unseen: float) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, base_score, score`` of every row.

    A row of the request is a shard's part of a batch: distinct runs, how many entries each has, and the entries (document of
    the batch), once per occurrence. What is known of the batch itself travels with one of them. A row of the answer has the sums
    of the documents with a word that is found there (``who``), and of those with any run that is (``whose``).
    """
    request = ["shard", "batch", "own", "runs", "entries", "docs"]
    answer_columns = ["batch", "own", "who", "known", "base", "whose", "score"]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n_bytes = 0

        def rows() -> Iterator[pa.RecordBatch]:
            before = np.cumsum([0, *(len(h[0]) for h in held)])
            own = np.concatenate([h[0] for h in held])
            runs = np.concatenate([h[1] for h in held])
            doc = np.concatenate([h[2] + np.int32(b) for h, b in zip(held, before, strict=False)])
            held.clear()
            order = np.argsort(own["key"], kind="stable")  # batches of the same rows are the same
            own, rank = own[order], np.empty(len(own), np.int32)
            rank[order] = np.arange(len(own), dtype=np.int32)
            number = arrow_text.mix(np.add.reduce(own["key"], keepdims=True))
            batch = int(number.view(np.int64)[0])
            order = np.argsort(runs)
            runs, doc = runs[order], rank[doc[order]]

            def row(shard: int, *values: bytes) -> pa.RecordBatch:
                return pa.record_batch([pa.array([shard], pa.int32()), pa.array([batch]), *(pa.array([v], pa.binary()) for v in values)], request)

            yield row(int(number[0]) % n_shards, own.tobytes(), b"", b"", b"")
            # shard s has the hashes whose high halves are s / n_shards of all or more
            cuts = np.searchsorted((runs >> np.uint64(32)) * np.uint64(n_shards) >> np.uint64(32), np.arange(n_shards + 1, dtype=np.uint64))
            for s in range(n_shards):
                a, b = cuts[s], cuts[s + 1]
                if a == b:
                    continue
                distinct, entries = np.unique(runs[a:b], return_counts=True)
                yield row(s, b"", packed_rising(distinct), packed(entries), packed(doc[a:b]))

        for part in arrow_text.chunks(batches):
            held.append(_own_sums(part, depth, head, start, unseen))
            n_bytes += len(held[-1][1]) * 12 + part.num_rows * ROW.itemsize
            if n_bytes >= BATCH_BYTES:
                yield from rows()
                n_bytes = 0
        if held:
            yield from rows()

    def answer(known: pa.Table, asked: pa.Table) -> pa.Table:
        """A row of sums for each row of the request."""
        runs, at = np.unique(known.column("run").to_numpy().view(np.uint64), return_inverse=True)
        n = np.bincount(at, known.column("n").to_numpy(), len(runs)).astype(np.int64)
        value = np.bincount(at, known.column("weight").to_numpy(), len(runs))
        out = []
        for i in range(asked.num_rows):
            row = {c: asked.column(c)[i].as_py() for c in request[1:]}
            mine = unpacked_rising(row["runs"])
            if not len(mine):
                out.append((row["batch"], row["own"], b"", b"", b"", b"", b""))
                continue
            counts, added, same = np.zeros(len(mine), np.int64), np.zeros(len(mine)), np.zeros(len(mine), bool)
            if len(runs):
                place = np.searchsorted(runs, mine).clip(0, len(runs) - 1)
                same = runs[place] == mine
                counts, added = np.where(same, n[place], 0), np.where(same, value[place], 0.0)
            entries = unpacked(row["entries"]).astype(np.int64)
            doc = unpacked(row["docs"]).astype(np.int64)
            size = int(doc.max()) + 1
            known = np.bincount(doc[np.repeat(counts > 0, entries)], minlength=size)
            who = np.flatnonzero(known)
            whose = np.flatnonzero(np.bincount(doc[np.repeat(same, entries)], minlength=size))
            base = np.bincount(doc, np.repeat(np.log10(counts + 1), entries), size)[who]
            score = np.bincount(doc, np.repeat(added, entries), size)[whose]
            out.append((row["batch"], b"", packed_rising(who), packed(known[who]), base.tobytes(), packed_rising(whose), score.tobytes()))
        kinds = [pa.int64(), *[pa.binary()] * 6]
        columns = zip(*out, strict=True) if out else [[]] * 7
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], answer_columns)

    def add(parts: pa.Table) -> pa.Table:
        """The rows of a batch with the sums from all shards. Batches of the same rows share a number: their sums are added up here."""
        rows = [x for x in parts.column("own").to_pylist() if x]
        own = np.frombuffer(b"".join(rows), ROW)
        size = len(own) // len(rows)
        known, base, score = np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
        for i in range(parts.num_rows):
            row = {c: parts.column(c)[i].as_py() for c in answer_columns[2:]}
            if row["whose"]:
                score[unpacked_rising(row["whose"]).astype(np.int64)] += np.frombuffer(row["score"])
            if row["who"]:
                who = unpacked_rising(row["who"]).astype(np.int64)
                known[who] += unpacked(row["known"]).astype(np.int64)
                base[who] += np.frombuffer(row["base"])

        def both(values: np.ndarray, more: np.ndarray) -> pa.Array:
            return pa.array(values + np.tile((more / len(rows)).astype(values.dtype), len(rows)))

        columns = [
            pa.array(own["doc_id"], mask=own["no_id"]),
            pa.array(own["held"]),
            pa.array(own["n_tokens"]),
            both(own["n_known"], known),
            both(own["base"], base),
            both(own["score"], score),
        ]
        return pa.table(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    binaries = ", ".join(f"{c} binary" for c in request[2:])
    asked = docs.mapInArrow(ask, f"shard int, batch long, {binaries}")
    shard = F.shiftright(F.shiftrightunsigned("run", 32) * n_shards, 32).cast("int")
    known = tail.select("run", "n", "weight").withColumn("shard", shard)
    binaries = ", ".join(f"{c} binary" for c in answer_columns[1:])
    answers = known.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(answer, f"batch long, {binaries}")
    columns = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return answers.groupBy("batch").applyInArrow(add, columns)


def scored(docs: DataFrame, depth: int = DEPTH, least_context: int = LEAST_CONTEXT, least_pair: int = LEAST_PAIR) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held"), F.col("text").cast("string").alias("text"))
    words = materialise(word_counts(rows))
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    table = weights(rows, words, total, distinct, depth, least_context, least_pair)
    remove_table(words)
    release_shuffles(docs.sparkSession)
    start = table.where(F.col("run") == int(START)).agg(F.sum("weight")).first()[0] or 0.0
    often, rest = (table.where(f) for f in (F.col("seen") >= HEAD * total, F.col("seen") < HEAD * total))
    n_tail = rest.count()
    head = Head(often, table, table.count())
    n_shards = int(max(1, -(-n_tail // SHARD_RUNS), -(-total // SHARD_TOKENS)))
    unseen = float(-np.log10(total + distinct + 1))
    sums = _sums(rows, head, rest, depth, n_shards, start, unseen)
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
