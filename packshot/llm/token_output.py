"""Token ids as files of compressed byte or bit planes, with a chunk index.

Documents are dealt out by ranges of ``doc_id`` and sorted inside each range, so the shards in order
hold the ids in ascending ``doc_id``. A shard is a row of files of about ``ids_per_file`` ids, whole
documents each. A file is cut into blocks of ``block`` ids; a block is transposed into planes (all
lowest bytes or bits first), each plane is a zstandard frame, and the index at the end of the file has
the place of every plane and the id count of every document. Spark stores the files in a table, one per
row, since only Spark's writers reach every store.

File, little-endian: planes of all blocks | document index (zstandard: doc_id, count as int64 pairs) |
chunk index (int64 rows: ids in the block, then the length of each plane) | footer (int64: number of
blocks, planes, bits per plane, documents, length of the document index, magic number).

Null or empty texts have the end id alone. Rows that repeat a ``doc_id`` stay separate documents, ordered
by text. A null ``doc_id`` sorts first and is read back as null. Further columns are ignored. An empty
table gives no file and no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packshot.llm import arrow_text
from packshot.llm.tokenize import encoder

END_ID = 2
BLOCK = 1 << 16
IDS_PER_FILE = 1 << 20
MAGIC = 0x314E4C504B504944  # fixed value of this format
_NULL = -(1 << 63)
FILES = "shard int, file_no int, position long, n_docs long, n_ids long, content binary"


def pack_file(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, block: int, bits: int) -> bytes:
    """One file from the ids of whole documents; ``bits`` is 8 for byte planes or 1 for bit planes."""
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    parts, index = [], []
    for at in range(0, len(ids), block):
        cut = np.ascontiguousarray(ids[at : at + block], "<u4")
        planes = cut.view(np.uint8).reshape(-1, 4).T
        if bits == 1:
            planes = np.unpackbits(np.ascontiguousarray(planes), axis=0, bitorder="little").reshape(4, 8, -1)
            planes = np.packbits(planes.reshape(32, -1), axis=1)
        frames = [press.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
        parts += frames
        index.append([len(cut), *map(len, frames)])
    documents = press.compress(np.stack([doc_ids, counts], 1).astype("<i8").tobytes())
    n_planes = 4 * 8 // bits
    footer = [len(index), n_planes, bits, len(doc_ids), len(documents), MAGIC]
    return b"".join([*parts, documents, np.array(index, "<i8").tobytes(), np.array(footer, "<i8").tobytes()])


def unpack_file(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``doc_ids, counts, ids`` of a file."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    blocks, n_planes, bits, _, size, magic = np.frombuffer(content[-48:], "<i8").tolist()
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = len(content) - 48 - blocks * (n_planes + 1) * 8
    index = np.frombuffer(content[at:-48], "<i8").reshape(blocks, n_planes + 1)
    documents = np.frombuffer(press.decompress(content[at - size : at]), "<i8").reshape(-1, 2)
    ids, start = [], 0
    for row in index:
        planes = []
        for length in row[1:].tolist():
            planes.append(np.frombuffer(press.decompress(content[start : start + length]), np.uint8))
            start += length
        planes = np.stack(planes)
        if bits == 1:
            planes = np.unpackbits(planes, axis=1)[:, : row[0]].reshape(4, 8, -1)
            planes = np.packbits(planes, axis=1, bitorder="little").reshape(4, -1)
        ids.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
    return documents[:, 0], documents[:, 1], np.concatenate(ids) if ids else np.zeros(0, np.uint32)


def encoded(raw: np.ndarray, offsets: np.ndarray, tokenizer_path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, each with ``end_id`` at its end, and their counts with that id."""
    ids, counts = encoder(tokenizer_path).encode(raw, offsets)
    sums = np.cumsum(counts + 1)
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    own = np.ones(len(out), bool)
    own[sums - 1] = False
    out[own] = ids
    return out, counts + 1


def token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, block: int = BLOCK, ids_per_file: int = IDS_PER_FILE, bits: int = 8
) -> DataFrame:
    """One row per file: ``shard, file_no, position`` (ids before it in its shard), ``n_docs, n_ids, content``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, file_no, position = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        n_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal file_no, position, n_held
            doc_ids, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            content = pack_file(doc_ids, counts, ids, block, bits)
            row = [shard, file_no, position, len(doc_ids), len(ids), content]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            file_no, position, n_held = file_no + 1, position + len(ids), 0
            held.clear()
            names = [x.split()[0] for x in FILES.split(", ")]
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        # a text has at most as many ids as bytes, so a slice does not overfill a file
        for part in arrow_text.chunks(batches, limit=min(arrow_text.CHUNK_BYTES, ids_per_file)):
            ids, counts = encoded(*arrow_text.buffer(part.column("text")), tokenizer_path, end_id)
            held.append((part.column("doc_id").fill_null(_NULL).to_numpy(zero_copy_only=False), counts, ids))
            n_held += len(ids)
            if n_held >= ids_per_file:
                yield flush()
        if held:
            yield flush()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, FILES)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, **options) -> DataFrame:
    """Store the files of :func:`token_files` below ``path`` and return the stored table."""
    files = token_files(docs, tokenizer_path, **options)
    files.write.parquet(path)
    return docs.sparkSession.read.schema(files.schema).parquet(path)


def read_token_files(files: DataFrame) -> DataFrame:
    """One row per document, from stored files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` is the number of ids of all documents before it. The sizes of the shards are summed up
    over one row per shard; inside a shard each file carries its position.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, position, content in zip(*(batch.column(c) for c in ("shard", "position", "content")), strict=True):
                doc_ids, counts, ids = unpack_file(content.as_py())
                ends = np.cumsum(counts)
                data, starts = memoryview(ids.astype("<u4")).cast("B"), ends - counts
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.record_batch(
                    [
                        pa.array([shard.as_py()] * len(ends), pa.int32()),
                        pa.array(doc_ids, pa.int64(), mask=doc_ids == _NULL),
                        pa.array(starts + position.as_py()),
                        pa.array(counts),
                        pa.array(sums, pa.int64()),
                    ],
                    ["shard", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = files.select("shard", "position", "content").mapInArrow(
        run, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    return rows.join(shards.select("shard", before.alias("before")), "shard").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
