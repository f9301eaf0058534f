"""Documents into sequences of fixed length: a linear grouping scheme, then best fit.

The work is planned on the number of pieces of each length (at most ``capacity`` numbers, whatever the
size of the input) and carried out by joining pieces with the plan on ``(length, rank)``.

1. Lengths above ``small`` are ranked, longest first, and cut into groups of equal cardinality; each
   group counts as the length of its longest piece.
2. The few sizes left make a cutting-stock problem: a linear program over fillings of one sequence, by
   column generation with a knapsack for the next filling; its whole parts are used.
3. Actual lengths of the group take the places of the rounded ones, which frees some room.
4. What is left and all small pieces go where they fit best, longest first; new sequences where none fits.

Which lengths count as large matters more than the number of groups, so the plan is made for a few
limits (:data:`LARGE`, shares of the capacity) and the one with the fewest sequences is taken.

Only documents longer than ``capacity`` are cut; the first piece takes the remainder. Null or empty texts
have the end id alone. Repeated rows are packed once each. An empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packshot.llm import arrow_text
from packshot.llm.token_output import END_ID, encoded
from packshot.runtime import materialise

CAPACITY = 1024
GROUPS = 64
LARGE = (8, 3, 2)
BUCKET_ROWS = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_text.chunks(batches):
            ids, counts = encoded(*arrow_text.buffer(part.column("text")), tokenizer_path, end_id)
            n = -(-counts // capacity)
            number = arrow_text.ragged(np.zeros(len(n), np.int64), n)
            head = counts - (n - 1) * capacity
            start = np.where(number == 0, 0, np.repeat(head, n) + (number - 1) * capacity)
            length = np.where(number == 0, np.repeat(head, n), capacity)
            at = np.repeat(np.cumsum(counts) - counts, n) + start
            data = memoryview(ids.astype("<u4")).cast("B")
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            yield pa.record_batch(
                [
                    part.column("doc_id").take(pa.array(np.repeat(np.arange(len(n)), n))),
                    pa.array(number.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def _best_filling(values: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size goes into one sequence for the highest value (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    small_first, worth = sizes[order], values[order]
    for room in range(int(small_first[0]), capacity + 1):
        usable = np.searchsorted(small_first, room, side="right")
        got = best[room - small_first[:usable]] + worth[:usable]
        k = int(got.argmax())
        best[room], choice[room] = (got[k], k) if got[k] > best[room - 1] + 1e-12 else (best[room - 1], -1)
    filling, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            filling[order[choice[room]]] += 1
            room -= int(small_first[choice[room]])
    return filling


def fillings(sizes: np.ndarray, amounts: np.ndarray, capacity: int, rounds: int = 4000) -> list[tuple[np.ndarray, int]]:
    """Fillings of one sequence and how often each is used: whole parts of the linear program."""
    basis = np.diag((capacity // sizes).astype(float))
    used = np.linalg.inv(basis)
    for _ in range(rounds):
        amount = used @ amounts
        prices = used.sum(axis=0)
        new = _best_filling(prices, sizes, capacity)
        if prices @ new <= 1 + 1e-7:
            break
        change = used @ new
        ratio = np.where(change > 1e-9, amount / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = new
        pivot = used[out] / change[out]  # the inverse after the exchange of one column
        used = used - np.outer(change, pivot)
        used[out] = pivot
    amount = np.linalg.solve(basis, amounts)
    return [(basis[:, i].astype(int), int(amount[i] + 1e-6)) for i in range(len(sizes)) if amount[i] >= 1 - 1e-6]


def plan(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[tuple, int]]:
    """Templates ``(lengths in a sequence, number of such sequences)``; ``counts[n]``: pieces of length n."""
    plans = [grouped_plan(counts, capacity, groups, capacity // share) for share in LARGE]
    return min(plans, key=lambda p: sum(times for _, times in p))


def grouped_plan(counts: np.ndarray, capacity: int, groups: int, small: int) -> list[tuple[tuple, int]]:
    """The plan with lengths above ``small`` as large ones."""
    left = counts.copy()
    templates: list[tuple[tuple, int]] = []
    if left[capacity]:
        templates.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    large = [(n, int(left[n])) for n in range(capacity - 1, small, -1) if left[n]]
    total = sum(c for _, c in large)
    runs: list[list[list[int]]] = []
    if total:
        share = -(-total // groups)
        room = 0
        for n, c in large:
            while c:
                if not room:
                    runs.append([])
                    room = share
                step = min(c, room)
                runs[-1].append([n, step])
                c, room = c - step, room - step
        merged: list[list[list[int]]] = []  # groups of one size are one group
        for run in runs:
            if merged and merged[-1][0][0] == run[0][0]:
                merged[-1] += run
            else:
                merged.append(run)
        runs = merged
        sizes = np.array([run[0][0] for run in runs])
        amounts = np.array([sum(c for _, c in run) for run in runs], float)
        for filling, times in sorted(fillings(sizes, amounts, capacity), key=lambda x: (x[0].tolist(), x[1])):
            slots = [g for g in range(len(sizes)) for _ in range(filling[g])]
            templates += _substituted(slots, times, runs, left)
    return _best_fit(templates, left, capacity)


def _substituted(slots: list[int], times: int, runs: list, left: np.ndarray) -> list[tuple[tuple, int]]:
    """``times`` sequences whose places hold the next actual lengths of their groups."""
    taken = []
    for g in slots:
        need, got = times, []
        while need and runs[g]:
            n, c = runs[g][0]
            step = min(c, need)
            got.append([n, step])
            left[n] -= step
            need -= step
            if step == c:
                runs[g].pop(0)
            else:
                runs[g][0][1] -= step
        if need:
            got.append([0, need])  # the place stays empty
        taken.append(got)
    out = []
    while taken and taken[0]:
        step = min(got[0][1] for got in taken)
        lengths = tuple(got[0][0] for got in taken if got[0][0])
        if lengths:
            out.append((lengths, step))
        for got in taken:
            got[0][1] -= step
            if not got[0][1]:
                got.pop(0)
    return out


def _best_fit(templates: list[tuple[tuple, int]], left: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    open_by_room: dict[int, list[list]] = defaultdict(list)
    for lengths, times in templates:
        open_by_room[capacity - sum(lengths)].append([lengths, times])
    for n in range(capacity, 0, -1):
        need = int(left[n])
        room = n
        while need:
            while room <= capacity and not open_by_room.get(room):
                room += 1
            if room > capacity:
                each = capacity // n
                whole, rest = divmod(need, each)
                if whole:
                    open_by_room[capacity - each * n].append([(n,) * each, whole])
                if rest:
                    open_by_room[capacity - rest * n].append([(n,) * rest, 1])
                break
            lengths, times = open_by_room[room][-1]
            step = min(times, need)
            if step == times:
                open_by_room[room].pop()
            else:
                open_by_room[room][-1][1] -= step
            open_by_room[room - n].append([(*lengths, n), step])
            need -= step
            if room - n >= n:  # the same sequences may now be the tightest
                room = n
    return [(tuple(x), c) for _, rows in sorted(open_by_room.items()) for x, c in rows]


def places(templates: list[tuple[tuple, int]]) -> np.ndarray:
    """Rows ``length, first rank, first sequence, offset``, sorted: where pieces of a length and rank go."""
    rows, rank, sequence = [], defaultdict(int), 0
    for lengths, times in templates:
        offset = 0
        for n in lengths:
            rows.append((n, rank[n], sequence, offset))
            rank[n] += times
            offset += n
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (a stored table with ``length``, at most ``capacity``) with ``sequence_id`` and ``offset``.

    Ranks within a length come from counts per (length, bucket), so a length that many pieces share is
    ranked by many tasks. The driver gets one number per length, tasks get the plan.
    """
    total = pieces.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    keys = [F.col(c) for c in pieces.columns]
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    counts = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    table = places(plan(histogram, capacity, groups))
    ahead = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy(*keys)
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(before, ["length", "_bucket"])
        .select(*pieces.columns, (F.col("_rank") + F.col("_before")).alias("_rank"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.int64(1) << 40
        starts = table[:, 0] * step + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            row = table[np.searchsorted(starts, length * step + rank, side="right") - 1]
            columns = [batch.column(c) for c in names]
            yield pa.record_batch(
                [*columns, pa.array(row[:, 2] + rank - row[:, 1]), pa.array(row[:, 3])], [*names, "sequence_id", "offset"]
            )

    names = pieces.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents as pieces with their places."""
    return pack(materialise(token_pieces(docs, tokenizer_path, capacity)), capacity)
