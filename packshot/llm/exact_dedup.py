"""Exact duplicates by grace hashing: buckets small enough for an open-addressing table of whole contents.

*Records.* A task reads its rows in windows of at most ``bucket_bytes`` of distinct content. Inside a window a
:class:`ContentTable` finds equal texts; the row with the largest id stands for them and is the only one
that keeps the text, with the number of rows it stands for. So a text that a third of all rows hold is
shipped once per window and not once per row.

*Partitioning.* Records are dealt into buckets by a hash of their digest, with a seed per level. A bucket that
fits (``bucket_bytes``, or fewer than :data:`FEW` records) is read by one task into a table, which
compares complete contents. Buckets that do not fit are dealt again by the next seed, and, since no hash parts
the copies of one text, spread over salts in which copies are collapsed as above. Their
records are stored (the spill files of the level, in the shared folder) and the next level begins.

*Result.* Every row is joined with the record that stands for it; the row of the largest id of a group
stays. Of rows that share that id and the text, the one that comes last in the table stays; a null id is less than
all others. Null texts count as empty. Further columns do not matter and are kept by
:func:`without_copies`. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packshot.llm import arrow_text
from packshot.runtime import broadcast_if_small, materialise

BUCKET_BYTES = 32 << 20
WINDOW_ROWS = 1 << 17
FEW = 4
MAX_TASKS = 100_000
RECORDS = "row long, doc_id long, n long, digest binary, root long, n_bytes long, text string"
RESULTS = "row long, keep_row long, keep_id long, group_size long"


class ContentTable:
    """Open addressing with linear probing: numbers distinct contents from 0 in the order they come."""

    def __init__(self, slots: int = 1 << 10) -> None:
        self.slots, self.hashes, self.contents = [-1] * slots, [], []
        self.n_bytes = 0

    def __len__(self) -> int:
        return len(self.contents)

    def number(self, hashed: int, content: bytes) -> int:
        """The number of ``content``, which is entered if it is new; equal hashes decide nothing."""
        slots, mask = self.slots, len(self.slots) - 1
        at = hashed & mask
        while (i := slots[at]) >= 0:
            if self.hashes[i] == hashed and self.contents[i] == content:
                return i
            at = (at + 1) & mask
        slots[at] = len(self.contents)
        self.hashes.append(hashed)
        self.contents.append(content)
        self.n_bytes += len(content)
        if 2 * len(self.contents) > len(slots):
            self._grow()
        return len(self.contents) - 1

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for i, hashed in enumerate(self.hashes):
            at = hashed & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def contents(column: pa.Array) -> list[bytes]:
    """The bytes of the texts of a column; none for a null."""
    wide = pa.types.is_large_string(column.type)
    return column.fill_null("").view(pa.large_binary() if wide else pa.binary()).to_pylist()


def _greatest(numbers: np.ndarray, ids: list, rows: np.ndarray, n: int) -> np.ndarray:
    """For each number the place of the row with the largest id, the largest row among equal ones."""
    known = np.array([i is not None for i in ids], bool)
    values = np.array([i or 0 for i in ids], np.int64)
    order = np.lexsort((rows, values, known, numbers))
    last = np.flatnonzero(np.append(numbers[order][1:] != numbers[order][:-1], True)) if len(order) else order
    out = np.zeros(n, np.int64)
    out[numbers[order[last]]] = order[last]
    return out


class _Window:
    """Rows of a task whose texts are in one table."""

    def __init__(self) -> None:
        self.table = ContentTable()
        self.numbers, self.ids, self.rows, self.ns, self.digests, self.rest = [], [], [], [], [], []

    def full(self, limit: int) -> bool:
        return self.table.n_bytes >= limit or len(self.rows) >= WINDOW_ROWS

    def batch(self) -> pa.RecordBatch:
        numbers, rows = np.array(self.numbers, np.int64), np.array(self.rows, np.int64)
        top = _greatest(numbers, self.ids, rows, len(self.table))
        is_root = np.zeros(len(rows), bool)
        is_root[top] = True
        held = np.bincount(numbers, np.array(self.ns), minlength=len(self.table)).astype(np.int64)
        found = self.table.contents
        texts = pa.array([found[i] if r else None for i, r in zip(self.numbers, is_root.tolist(), strict=True)], pa.binary())
        sizes = np.array([len(c) for c in found], np.int64)[numbers]
        columns = [
            pa.array(rows), pa.array(self.ids, pa.int64()), pa.array(np.where(is_root, held[numbers], 0)),
            pa.array(self.digests, pa.binary()), pa.array(rows[top][numbers]),
            pa.array(np.where(is_root, sizes, 0)), texts.view(pa.string()),
        ]
        names = [c.split()[0] for c in RECORDS.split(", ")]
        if self.rest:
            columns, names = [*columns, pa.concat_arrays(self.rest)], [*names, "rest"]
        return pa.record_batch(columns, names)


def _collapsed(records: DataFrame, limit: int) -> DataFrame:
    """``records`` (row, doc_id, n, text, and maybe digest and rest) with ``root``, the row that stands for each."""
    has_digest, has_rest = "digest" in records.columns, "rest" in records.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = _Window()
        for part in arrow_text.chunks(batches):
            texts = contents(part.column("text"))
            found = part.column("digest").to_pylist() if has_digest else [hashlib.sha256(t).digest() for t in texts]
            window.numbers += [window.table.number(int.from_bytes(d[-8:], "big"), t) for d, t in zip(found, texts, strict=True)]
            window.digests += found
            window.ids += part.column("doc_id").to_pylist()
            window.rows += part.column("row").to_pylist()
            window.ns += part.column("n").to_pylist()
            if has_rest:
                window.rest.append(part.column("rest"))
            if window.full(limit):
                yield window.batch()
                window = _Window()
        if window.rows:
            yield window.batch()

    schema = RECORDS
    if has_rest:
        schema = f"{RECORDS}, rest {records.schema['rest'].dataType.simpleString()}"
    return records.mapInArrow(run, schema)


def _solve(group: pa.Table) -> pa.Table:
    """The group of every record of a bucket, by one table of complete contents."""
    table = ContentTable(1 << max(4, (4 * group.num_rows - 1).bit_length()))
    digests, texts = group.column("digest").to_pylist(), group.column("text").combine_chunks()
    texts = contents(texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts)
    numbers = np.array([table.number(int.from_bytes(d[-8:], "big"), t) for d, t in zip(digests, texts, strict=True)], np.int64)
    ids, rows = group.column("doc_id").to_pylist(), group.column("row").to_numpy()
    top = _greatest(numbers, ids, rows, len(table))
    sizes = np.bincount(numbers, group.column("n").to_numpy(), minlength=len(table)).astype(np.int64)
    keep_ids = pa.array(ids, pa.int64()).take(pa.array(top[numbers]))
    columns = [pa.array(rows), pa.array(rows[top][numbers]), keep_ids, pa.array(sizes[numbers])]
    return pa.table(columns, [c.split()[0] for c in RESULTS.split(", ")])


def _grouped(records: DataFrame, limit: int, level: int = 0) -> DataFrame:
    """``(row, keep_row, keep_id, group_size)`` of stored ``records``, each with a text."""
    total = records.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(1, math.ceil(2 * total / limit))
    tasks = min(buckets, MAX_TASKS)
    bucket = F.pmod(F.xxhash64(F.lit(level), "digest"), F.lit(buckets)).alias("bucket")
    records = records.select("row", "doc_id", "n", "digest", "n_bytes", "text", bucket)
    sizes = records.groupBy("bucket").agg(F.sum("n_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    large = materialise(sizes.where((F.col("_bytes") > limit) & (F.col("_rows") >= FEW)))
    if large.isEmpty():
        return _solved(records, tasks)
    wanted = broadcast_if_small(large)
    fitting = _solved(records.join(wanted, "bucket", "left_anti"), tasks)
    # a salt holds two records or more, so that copies meet in it
    salts = F.least(F.ceil(F.col("_bytes") / limit), F.expr("_rows div 2"))
    again = records.join(wanted.withColumn("_salts", salts), "bucket").withColumn("_salt", F.pmod(F.xxhash64("row"), "_salts"))
    of_large = large.agg(F.sum("_bytes")).first()[0]
    finer = F.pmod(F.xxhash64(F.lit(level + 1), "digest"), F.lit(max(1, math.ceil(2 * of_large / limit))))
    tasks = min(max(2, math.ceil(of_large / limit)), MAX_TASKS)
    spread = again.repartition(tasks, "bucket", "_salt", finer).select("row", "doc_id", "n", "digest", "text")
    spilled = materialise(_collapsed(spread, limit))
    inner = _grouped(spilled.where("root = row"), limit, level + 1).withColumnRenamed("row", "root")
    return fitting.unionByName(spilled.select("row", "root").join(inner, "root").drop("root"))


def _solved(records: DataFrame, tasks: int) -> DataFrame:
    return records.drop("n_bytes").repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_solve, RESULTS)


def _rows_and_groups(docs: DataFrame, limit: int, rest: bool) -> tuple[DataFrame, DataFrame]:
    """Stored rows of ``docs`` with the record that stands for each, and the group of every record."""
    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.lit(1).cast("long").alias("n"),
        "text",
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")] if rest else []),
    )
    rows = materialise(_collapsed(source, limit))
    return rows, _grouped(rows.where("root = row"), limit)


def duplicate_groups(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` per row of ``docs``."""
    rows, groups = _rows_and_groups(docs, bucket_bytes, rest=False)
    found = rows.select("row", "root", "doc_id", "digest").join(groups.withColumnRenamed("row", "root"), "root")
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns; a null text that stays for its group comes back as empty."""
    rows, groups = _rows_and_groups(docs, bucket_bytes, rest=True)
    stay = groups.where("row = keep_row").select("row")
    kept = rows.join(stay, "row", "left_semi")  # the row that stays stands for its group, so it has the text
    return kept.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
