"""Documents whose sets of word shingles are similar, by a size-aware heavy-light join.

Two sets link when ``|A and B| >= threshold * |A or B|``. Sets of one content are one node.

*Small sets.* For a pair of sizes (s, t) the threshold asks for an overlap c. Every small set enumerates its subsets of
c shingles, for each size that it can link with; sets of sizes s and t under one subset do link. So a subset's
sets are tied to one of them, and nothing has to be verified.

*Large sets* scan inverted lists. With all shingles in one order, rare first, sets that link share one of
their first ``s - ceil(threshold * s) + 1``; only these are listed, and of the lists only those that two sets share go
on. Every entry of a list is paired with its smallest and its largest set. Sizes and sketches of parity bits
rule most pairs out: the bits in which two sketches differ are at most the shingles in which the sets differ. Each set is
verified with its most likely partner first, then the pairs that still lie between components.

Only lists that still hold sets of different components go on, put together where they are much the same
(:func:`mixed_lists`). Each is read by a task, in pairs of blocks of :data:`BLOCK_ROWS` if it is long, which compares
sets of different components by size and sketch. It names the pairs that may link, which are verified, or, where these are
many more than the sets in them, the sets, which are compared whole inside a task (:func:`exhausted`). So no link
between components is lost, and no group of sets is expanded into rows of all its pairs.

A set that has to be verified is made from its text once and stored (:func:`stored_sets`).

*The boundary* is the size up to which subsets cost less rows than lists and verification, by the counts of set sizes.

The order counts shingles in hash bins over all documents; each task passes on its crowded bins. It decides
about the work only, not about results. Shingles are 64-bit hashes.

Null and empty texts have no set and link with nothing. Repeated rows and a repeated ``doc_id`` give a row each. Other
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packshot.llm import arrow_text, shingles
from packshot.llm.components import components
from packshot.runtime import materialise

WORDS, PERCENT = 3, 90
LEVEL_BITS = 20
SMALL_SIZES = 64
VERIFY_COST = 0.25
BLOCK_ROWS = 4096
BLOCK_BYTES = 8 << 20  # of sets
PAIR_BYTES = 1 << 23
GUESTS = 4096
GIVEN = 1 << 20
DENSE = 8
SHORT_BITS = 4
SKETCH_BITS, LARGE_SKETCH_BITS, LARGE_SET = 1024, 8192, 700
MAX_SUBSETS = 5000


def least_overlap(s: int, t: int, percent: int) -> int:
    """The least overlap with which sets of these sizes link."""
    return -(-percent * (s + t) // (100 + percent))


def prefix_length(s, percent: int):
    return s - (-(-percent * s // 100)) + 1


def partners(s: int, percent: int) -> list[int]:
    """Sizes that a set of size ``s`` can link with."""
    return [t for t in range(-(-percent * s // 100), 100 * s // percent + 1) if least_overlap(s, t, percent) <= min(s, t)]


def subset_rows(s: int, most: int, percent: int) -> int:
    return sum(comb(s, s - least_overlap(s, t, percent)) for t in partners(s, percent) if t <= most)


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest size that counts as small: the cheapest split of the rows to be made."""
    best, best_cost = 0, None
    list_cost = lambda s: prefix_length(s, percent) + VERIFY_COST * s
    for x in range(SMALL_SIZES + 1):
        if x and subset_rows(x, x, percent) > MAX_SUBSETS:
            break
        listed_from = -(-percent * (x + 1) // 100)
        cost = sum(n * subset_rows(s, x, percent) for s, n in sizes.items() if 0 < s <= x)
        cost += sum(n * list_cost(s) for s, n in sizes.items() if s >= max(1, listed_from))
        if best_cost is None or cost < best_cost:
            best, best_cost = x, cost
    return best


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, text_key`` (hash of the text), ``node`` (hash of the set, null without one), ``size, sketch``; no shuffle.

    Rows with a ``bin`` are no documents: ``size`` shingles fell into that crowded bin of hashes in a task.
    """
    n_bins = 1 << LEVEL_BITS
    names = ["doc_id", "text_key", "node", "size", "sketch", "bin"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_bins, np.int64)
        for part in arrow_text.chunks(batches):
            sets = list(shingles.text_shingles(part, k))
            bins = (np.concatenate(sets) & np.uint64(n_bins - 1)).astype(np.int64)
            counts += np.bincount(bins, minlength=n_bins)
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array([node_of(x) if len(x) else None for x in sets], pa.int64()),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([sketch(x) if len(x) else None for x in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int64()),
                ],
                names,
            )
        mean = counts.mean()
        at = np.flatnonzero(counts > mean + 6 * np.sqrt(mean) + 6)
        none = pa.nulls(len(at), pa.int64())
        yield pa.record_batch([none, none, none, pa.array(counts[at]), pa.nulls(len(at), pa.binary()), pa.array(at)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, node long, size long, sketch binary, bin long")


def node_of(members: np.ndarray) -> int:
    return int(arrow_text.mix(np.add.reduce(arrow_text.mix(members), keepdims=True) + np.uint64(len(members))).view(np.int64)[0])


def sketch(members: np.ndarray) -> bytes:
    """Parity of the number of shingles in each of a number of bins, more bins for large sets."""
    bits = SKETCH_BITS if len(members) < LARGE_SET else LARGE_SKETCH_BITS
    bins = (arrow_text.mix(members ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(bins, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def bin_levels(bins: DataFrame) -> np.ndarray:
    """A level for each bin of shingle hashes: the binary order of magnitude of counts in crowded bins, else 0."""
    levels = np.zeros(1 << LEVEL_BITS, np.uint8)
    for row in bins.groupBy("bin").agg(F.sum("size").alias("n")).toLocalIterator():
        levels[row["bin"]] = int(row["n"]).bit_length()
    return levels


def set_keys(docs: DataFrame, k: int, percent: int, small: int, levels: np.ndarray) -> DataFrame:
    """``kind`` (0 subset, 1 list), ``key, rank, node, size``: what sets are found by.

    ``rank`` is 0 for the sets that all others under the key link with (kind 0), else the size.
    """
    listed_from = -(-percent * (small + 1) // 100)
    plans = {
        s: [(min(s, t), max(s, t), s - least_overlap(s, t, percent)) for t in partners(s, percent) if t <= small]
        for s in range(1, small + 1)
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64(len(levels) - 1)
        for part in arrow_text.chunks(batches):
            keys, nodes, sizes, kinds, ranks = [], [], [], [], []

            def add(found: np.ndarray, node: int, size: int, kind: int, rank: int) -> None:
                keys.append(found)
                for column, value in ((nodes, node), (sizes, size), (kinds, kind), (ranks, rank)):
                    column.append(np.full(len(found), value, np.int64))

            for members in shingles.text_shingles(part, k):
                size = len(members)
                if not size:
                    continue
                node = node_of(members)
                if size <= small:
                    single = arrow_text.mix(members + np.uint64(0x2545F4914F6CDD1D))
                    total = np.add.reduce(single, keepdims=True)
                    for low, high, drop in plans[size]:
                        out = np.array(list(combinations(range(size), drop)), np.int64)
                        lost = single[out].sum(axis=1, dtype=np.uint64)
                        tag = np.array([(low * 4096 + high) * 2], np.uint64)
                        found = arrow_text.mix(total - lost + tag)
                        add(found, node, size, 0, int(size != low))
                if size >= listed_from:
                    level = levels[(members & mask).astype(np.int64)]
                    n = prefix_length(size, percent)
                    rare = np.lexsort((members, level))[:n]
                    add(members[rare], node, size, 1, size)
            columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (kinds, keys, ranks, nodes, sizes)]
            columns[1] = columns[1].view(np.int64)
            types = [pa.int8(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
            yield pa.record_batch(
                [pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types, strict=True)],
                ["kind", "key", "rank", "node", "size"],
            )

    return docs.select("text").mapInArrow(run, "kind byte, key long, rank int, node long, size int")


def shared_keys(keys: DataFrame) -> DataFrame:
    """Rows of stored ``keys`` that at least two nodes have, each with the least and the greatest of them by rank, and these ranks.

    Keys of a single node are told by an aggregate of numbers and dropped by a hash filter before other rows move.
    Copies of a document give equal rows; the aggregates don't mind.
    """

    def shared(rows: DataFrame, *more) -> DataFrame:
        found = rows.groupBy("kind", "key").agg(F.min("node").alias("_a"), F.max("node").alias("_b"), F.min("rank").alias("low_rank"), *more)
        return found.where("_a != _b and (kind = 1 or low_rank = 0)").drop("_a", "_b")

    some = materialise(shared(keys).select("key"))
    known = shingles.hash_filter(some, F.col("key"), shingles.filter_bits(some.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shingles.in_filter(known, batch.column("key").to_numpy())))

    rows = materialise(keys.mapInArrow(run, keys.schema))
    # by rank, and by node where ranks are equal
    place = F.col("rank").cast("long") * (1 << 40) + F.shiftrightunsigned("node", 24)
    ends = shared(rows, F.min_by("node", place).alias("low"), F.max_by("node", place).alias("high"), F.max("rank").alias("high_rank"))
    return rows.join(ends, ["kind", "key"]).distinct()


def stored_sets(wanted: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``node, members`` of the nodes of ``wanted`` (``node, doc_id`` of one of its documents): one pass over the texts.

    A hash filter lets their documents through; copies may bring a set again, from other tasks.
    """
    bits = shingles.filter_bits(wanted.count())
    known = shingles.hash_filter(wanted, F.col("node").bitwiseXOR(F.coalesce("doc_id", F.lit(0))), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for part in arrow_text.chunks(batches):
            ids = part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            sets = list(shingles.text_shingles(part, k))
            nodes = np.array([node_of(x) if len(x) else 0 for x in sets], np.int64)
            chosen = []
            for i in np.flatnonzero(shingles.in_filter(known, nodes ^ ids)).tolist() if len(sets) else []:
                if len(sets[i]) and int(nodes[i]) not in given:
                    given.add(int(nodes[i]))
                    chosen.append(i)
            if len(given) > GIVEN:
                given.clear()
            lengths = np.array([len(sets[i]) for i in chosen], np.int64)
            values = np.concatenate([sets[i] for i in chosen]).view(np.int64) if chosen else np.zeros(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            members = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.record_batch([pa.array(nodes[chosen]), members], ["node", "members"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(texts.mapInArrow(run, "node long, members array<long>"))


def _linking(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` that link, on whole sets.

    Of a pair the node with more pairs is the host: its set comes once, and once more for every :data:`GUESTS` pairs, which
    are dealt to as many tasks; the guest's set comes with the pair.
    """
    ends = pairs.select(F.explode(F.array("u", "v")).alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    degree = lambda c: ends.select(F.col("host").alias(c), F.col("n").alias(f"n_{c}"))
    turned = pairs.join(degree("u"), "u").join(degree("v"), "v")
    first = (F.col("n_u") > F.col("n_v")) | ((F.col("n_u") == F.col("n_v")) & (F.col("u") < F.col("v")))
    dealt = turned.select(
        F.when(first, F.col("u")).otherwise(F.col("v")).alias("host"),
        F.when(first, F.col("v")).otherwise(F.col("u")).alias("guest"),
        F.ceil(F.greatest("n_u", "n_v") / GUESTS).alias("salts"),
    )
    dealt = materialise(dealt.withColumn("salt", F.pmod(F.xxhash64("guest"), F.col("salts"))).drop("salts").distinct())
    hosts = dealt.select("host", "salt").distinct().select("host", "salt", F.col("host").alias("node"))
    sides = dealt.select("host", "salt", F.col("guest").alias("node")).unionByName(hosts)
    rows = sides.join(sets, "node").select("host", "salt", (F.col("node") != F.col("host")).alias("guest"), "node", "members")
    rows = rows.repartition("host", "salt").sortWithinPartitions("host", "salt", "guest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, own = None, None
        for batch in batches:
            found = []
            members = batch.column("members")
            offsets, values = members.offsets.to_numpy(), members.values.to_numpy()
            for i, (h, guest, node) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("host", "guest", "node")), strict=True)):
                mine = values[offsets[i] : offsets[i + 1]].view(np.uint64)
                if not guest:
                    host, own = h, mine.copy()
                elif h == host and _linking(own, mine, percent):
                    found.append((min(h, node), max(h, node)))
            out = np.array(found, np.int64).reshape(-1, 2)
            yield pa.record_batch([pa.array(out[:, 0].copy()), pa.array(out[:, 1].copy())], ["u", "v"])

    return rows.mapInArrow(run, "u long, v long").distinct()


def plausible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``u, v, far`` of the pairs that sizes and sketches do not rule out; only these need their whole sets.

    ``far``: the bits that differ, of the room there is for shingles that differ.
    """
    side = lambda n: sketches.select(F.col("node").alias(n), F.col("size").alias(f"size_{n}"), F.col("sketch").alias(f"sketch_{n}"))
    sizes = 100 * F.least("size_u", "size_v") >= percent * F.greatest("size_u", "size_v")
    joined = pairs.join(side("u"), "u").join(side("v"), "v").where(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            both = sum(batch.column(f"size_{n}").to_numpy() for n in "uv")
            room = _room(both, percent)
            sketched = zip(batch.column("sketch_u").to_pylist(), batch.column("sketch_v").to_pylist(), strict=True)
            differ = np.array([int(np.bitwise_count(a ^ b).sum()) for a, b in map(_folded, sketched)])
            found = batch.select(["u", "v"]).append_column("far", pa.array(differ / np.maximum(room, 1)))
            yield found.filter(pa.array(differ <= room))

    return joined.mapInArrow(run, "u long, v long, far double")


def nearest(pairs: DataFrame) -> DataFrame:
    """Of every node the pair that most likely links."""
    both = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("other")), F.struct(F.col("v").alias("node"), F.col("u").alias("other")))
    ends = pairs.select("far", F.explode(both).alias("e")).groupBy("e.node").agg(F.min(F.struct("far", "e.other")).alias("best"))
    other = F.col("best.other")
    return ends.select(F.least("node", other).alias("u"), F.greatest("node", other).alias("v")).distinct()


def between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components, with these (``a, b``)."""
    side = lambda c, n: labels.select(F.col("node").alias(c), F.col("component").alias(n))
    joined = pairs.join(side("u", "a"), "u", "left").join(side("v", "b"), "v", "left")
    return joined.withColumns({"a": F.coalesce("a", "u"), "b": F.coalesce("b", "v")}).where("a != b")


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links: only the components that these join are looked at."""
    new = materialise(between(links, labels).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    if new.isEmpty():
        return labels
    above = materialise(components(new))
    single = above.join(labels, "node", "left_anti").select("node", F.col("node").alias("component"))
    up = above.select(F.col("node").alias("component"), F.col("component").alias("_up"))
    joined = labels.unionByName(single).join(up, "component", "left")
    return materialise(joined.select("node", F.coalesce("_up", "component").alias("component")))


def _room(both: np.ndarray, percent: int) -> np.ndarray:
    """Shingles in which linked sets may differ, of sizes that add up to ``both``."""
    return both - 2 * (-(-percent * both // (100 + percent)))


def mixed_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows ``key, node, size`` of lists that hold sets of different components, with near-equal lists put together.

    Sets that resemble each other stand together in many lists, whose least nodes are then mostly the same. Lists with one
    least node are a bunch; where all pairs of a bunch are fewer than the pairs of its lists, the bunch is one list.
    """
    marked = lists.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kinds = marked.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("n"), F.min("node").alias("first"))
    kinds = materialise(kinds.where("a != b").select("key", "n", "first"))
    rows = materialise(lists.join(kinds.select("key", "first"), "key"))
    bunched = rows.groupBy("first", "node").agg(F.min("size").alias("size"))
    square = F.count(F.lit(1)).cast("double") * F.count(F.lit(1))
    in_lists = kinds.groupBy("first").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("list_pairs"))
    joint = bunched.groupBy("first").agg(square.alias("all_pairs")).join(in_lists, "first")
    joint = materialise(joint.where("all_pairs < list_pairs").select("first"))
    apart = rows.join(joint, "first", "left_anti").select("key", "node", "size")
    together = bunched.join(joint, "first").select(F.xxhash64(F.lit("bunch"), "first").alias("key"), "node", "size")
    return materialise(apart.unionByName(together))


def _dealt(lists: DataFrame, labels: DataFrame, blocks: Column) -> DataFrame:
    """Rows of lists with different components, in pairs ``x, y`` of ``blocks`` (an aggregate over a list)."""
    marked = lists.join(labels, "node", "left").select("key", "node", "size", F.coalesce("component", "node").alias("component"))
    mixed = marked.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), blocks.cast("int").alias("blocks"))
    dealt = marked.join(mixed.where("a != b").select("key", "blocks"), "key")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        "key", "node", "size", "component", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
    )


def _by_list(rows: DataFrame, of_lists: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``of_lists`` makes of whole lists (or pairs of blocks), which stand one after the other in a task."""
    rows = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None  # the list that the last batch may have cut
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            starts = _list_starts(table)
            if len(starts) > 1:
                yield from of_lists(table.slice(0, int(starts[-1])).combine_chunks())
            rest = table.slice(int(starts[-1])) if len(starts) else table
        if rest is not None and rest.num_rows:
            yield from of_lists(rest.combine_chunks())

    return rows.mapInArrow(run, schema)


def open_pairs(lists: DataFrame, labels: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that stand in one list and may link, or the sets of crowded lists: ``group, u, v``."""
    dealt = _dealt(lists, labels, F.ceil(F.count(F.lit(1)) / BLOCK_ROWS))
    return _by_list(dealt.join(_short_sketches(sketches, percent), "node"), lambda rows: _named(rows, percent), "group long, u long, v long")


def exhausted(lists: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``u, v`` that join all components that links inside the lists join, by whole sets in the tasks."""
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("size") * 8 / BLOCK_BYTES))
    dealt = _dealt(lists, labels, blocks)
    return _by_list(dealt.join(sets.dropDuplicates(["node"]), "node"), lambda rows: _spanned(rows, percent), "u long, v long").distinct()


def _short_sketches(sketches: DataFrame, percent: int) -> DataFrame:
    """``node, sketch`` folded down as far as sketches of unlike sets still differ in more bits than linked ones may.

    About half the bits of unlike sets differ. 256 bits at least; the bound holds for folded sketches too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            need = SHORT_BITS * _room(2 * sizes, percent) if len(sizes) else sizes
            short = []
            for bits, whole in zip(need.tolist(), batch.column("sketch").to_pylist(), strict=True):
                width = 32
                while width * 8 < bits and width < len(whole):
                    width *= 2
                short.append(np.bitwise_xor.reduce(np.frombuffer(whole, np.uint8).reshape(-1, width), axis=0).tobytes())
            yield pa.record_batch([batch.column("node"), pa.array(short, pa.binary())], ["node", "sketch"])

    return sketches.select("node", "size", "sketch").mapInArrow(run, "node long, sketch binary")


def _folded(sketches: Sequence[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded down to the shortest."""
    width = min(map(len, sketches))
    same = [s if len(s) == width else np.bitwise_xor.reduce(np.frombuffer(s, np.uint8).reshape(-1, width), axis=0).tobytes() for s in sketches]
    return np.frombuffer(b"".join(same), np.uint64).reshape(len(same), width // 8)


def _list_starts(table: pa.Table) -> np.ndarray:
    if not table.num_rows:
        return np.zeros(0, np.int64)
    key = np.stack([table.column(c).to_numpy() for c in ("key", "x", "y")])
    return np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1])


def _candidates(size: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Those of the pairs ``i, j`` that sizes and sketches leave, nearest first, and whether they most likely link."""
    room = _room(size[i] + size[j], percent)
    near = np.abs(size[i] - size[j]) <= room
    i, j, room = i[near], j[near], room[near]
    differ = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1)
    ok = differ <= room
    i, j, room, differ = i[ok], j[ok], room[ok], differ[ok]
    # the bits that differ say how many shingles differ, less those that meet in a bin
    n_bits = 64 * bits.shape[1]
    estimate = -n_bits / 2 * np.log(np.maximum(1 - 2 * differ / n_bits, 1e-9))
    order = np.argsort(differ, kind="stable")
    return i[order], j[order], (estimate <= room)[order]


def _compared(rows: pa.Table, sketches: list[bytes], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The rows ``i, j`` of whole lists that sizes and sketches leave, nearest first, in parts, and the roots to keep.

    Lists are compared together, up to :data:`PAIR_BYTES` of sketches. Who joins components sets their roots; pairs of one root
    do not come up again in later parts.
    """
    size, root, block = (rows.column(c).to_numpy().copy() for c in ("size", "component", "block"))
    crossing = rows.column("x").to_numpy() != rows.column("y").to_numpy()
    size = size.astype(np.int64)
    starts = _list_starts(rows)
    number = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(size))))
    widths = np.array([len(x) for x in sketches])
    for width in np.unique(widths).tolist():
        # sets of like sizes have one width or two neighbours
        mine = np.flatnonzero((widths == width) | (widths == 2 * width))
        first = np.flatnonzero(np.append(True, number[mine][1:] != number[mine][:-1]))
        before = np.arange(len(mine)) - np.repeat(first, np.diff(np.append(first, len(mine))))  # rows of the list to compare with
        bits = _folded([sketches[r] for r in mine.tolist()] + [b"\0" * width])
        done = np.concatenate([[0], np.cumsum(before)])
        at = 0
        while at < len(mine):
            to = max(at + 1, int(np.searchsorted(done, done[at] + PAIR_BYTES // width, side="right")) - 1)
            part = np.arange(at, to)
            m = np.repeat(part, before[part])
            n = arrow_text.ragged(part - before[part], before[part])
            i, j = mine[m], mine[n]
            apart = (root[i] != root[j]) & ((widths[i] == width) | (widths[j] == width))
            apart &= ~crossing[i] | (block[i] != block[j])
            m, n, likely = _candidates(size[mine], bits, m[apart], n[apart], percent)
            yield mine[m], mine[n], likely, root
            at = to


def _joined_roots(root: np.ndarray, starts: np.ndarray, p: int, q: int) -> None:
    """Give the rows of ``p``'s list with the root of ``q`` the root of ``p``."""
    at = int(np.searchsorted(starts, p, side="right"))
    own = slice(int(starts[at - 1]), int(starts[at]) if at < len(starts) else len(root))
    root[own] = np.where(root[own] == root[q], root[p], root[own])


def _named(rows: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """What whole lists (or pairs of blocks) name by sketches: ``group, u, v``.

    All pairs that may link, or, of a list with many more pairs than sets in them, these sets alone (``v`` null).
    """
    node, starts = rows.column("node").to_numpy(), _list_starts(rows)
    key, x, y = (rows.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("key", "x", "y"))
    group = arrow_text.mix(key + arrow_text.mix(x * np.uint64(1 << 32) + y)).view(np.int64)
    found = [(i, j) for i, j, _, _ in _compared(rows, rows.column("sketch").to_pylist(), percent)]
    i, j = (np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64) for c in (0, 1))
    number = np.searchsorted(starts, i, side="right") - 1
    involved = np.zeros(len(node), bool)
    involved[i] = involved[j] = True
    of = np.searchsorted(starts, np.flatnonzero(involved), side="right") - 1
    dense = np.bincount(number, minlength=len(starts)) > DENSE * np.bincount(of, minlength=len(starts))
    few, alone = ~dense[number], np.flatnonzero(involved)[dense[of]]
    u, v = np.minimum(node[i], node[j])[few], np.maximum(node[i], node[j])[few]
    columns = [np.concatenate([group[i[few]], group[alone]]), np.concatenate([u, node[alone]])]
    yield pa.record_batch([*map(pa.array, columns), pa.concat_arrays([pa.array(v), pa.nulls(len(alone), pa.int64())])], ["group", "u", "v"])


def _spanned(rows: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Links that span what links in whole lists, verified on their sets."""
    node, starts = rows.column("node").to_numpy(), _list_starts(rows)
    members = rows.column("members").combine_chunks()
    members = members.chunk(0) if isinstance(members, pa.ChunkedArray) else members
    offsets, values = members.offsets.to_numpy(), members.values.to_numpy().view(np.uint64)
    sets = [values[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    pairs: list[tuple[int, int]] = []
    for i, j, _, root in _compared(rows, [sketch(x) for x in sets], percent):
        for p, q in zip(i.tolist(), j.tolist(), strict=True):
            if root[p] != root[q] and _linking(sets[p], sets[q], percent):
                pairs.append(tuple(sorted((int(node[p]), int(node[q])))))
                _joined_roots(root, starts, p, q)
    found = np.array(pairs, np.int64).reshape(-1, 2)
    yield pa.record_batch([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["u", "v"])


def jaccard_labels(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Membership ``doc_id, text_key, node, size`` of every row, and ``node, component`` of every node that links with another."""
    stored = materialise(document_sets(docs, k))
    members = stored.where("bin is null").drop("bin")
    nodes = members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("size").alias("size"), F.first("sketch").alias("sketch"))
    nodes = materialise(nodes)
    sizes = {r["size"]: r["n"] for r in nodes.groupBy(F.least("size", F.lit(2 * SMALL_SIZES)).alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    keys = materialise(set_keys(docs, k, percent, boundary(sizes, percent), bin_levels(stored.where("bin is not null"))))
    shared = materialise(shared_keys(keys))
    ordered = [F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")]
    sure = shared.where("kind = 0 and node != low").select("node", F.col("low").alias("other")).select(*ordered).distinct()
    lists = shared.where("kind = 1")
    end = F.explode(F.array(*[F.struct(F.col(c).alias("other"), F.col(f"{c}_rank").alias("far")) for c in ("low", "high")]))
    ends = lists.select("node", "size", end.alias("e")).where(100 * F.least("size", "e.far") >= percent * F.greatest("size", "e.far"))
    ends = ends.select("node", "e.other").where("node != other").select(*ordered).distinct()
    reps = nodes.select("node", "doc_id")

    def sets_of(wanted: DataFrame) -> DataFrame:
        return stored_sets(materialise(wanted.select("node").distinct().join(reps, "node")), docs, k)

    likely = materialise(plausible(ends, nodes, percent))
    sets = sets_of(likely.select(F.explode(F.array("u", "v")).alias("node")))
    best = materialise(nearest(likely))
    labels = materialise(components(sure.unionByName(verified(best, sets, percent))))
    others = materialise(between(likely.join(best, ["u", "v"], "left_anti"), labels).select("u", "v"))
    if not others.isEmpty():
        labels = relabelled(labels, materialise(verified(others, sets, percent)))
    lists = mixed_lists(lists.select("key", "node", "size"), labels)
    named = materialise(open_pairs(lists, labels, nodes, percent))
    if named.isEmpty():
        return members, labels
    tried = likely.select("u", "v")
    pairs = materialise(plausible(named.where("v is not null").select("u", "v").distinct().join(tried, ["u", "v"], "left_anti"), nodes, percent).select("u", "v"))
    crowded = named.where("v is null").select(F.col("group").alias("key"), F.col("u").alias("node")).join(nodes.select("node", "size"), "node")
    crowded = materialise(crowded.select("key", "node", "size"))
    sets = sets_of(pairs.select(F.explode(F.array("u", "v")).alias("node")).unionByName(crowded.select("node")))
    links = verified(pairs, sets, percent).unionByName(exhausted(crowded, labels, sets, percent))
    return members, relabelled(labels, materialise(links))


def _grouped(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows of :func:`jaccard_labels`, each with its class, its component and ``stays``, the row that stands for the component.

    That row has the least ``doc_id``, one without an id only if all are, and of several texts under it the least ``text_key``.
    """
    members, labels = jaccard_labels(docs, k, percent)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    reps = members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("class_id"), F.min(row).alias("stays"))
    labelled = reps.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("class_id").alias("component_id"), F.min("stays").alias("stays"))
    found = labelled.drop("stays").join(least, "component").select("node", "class_id", "component_id", "stays")
    return members.join(found, "node", "left")


def jaccard_components(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id`` (least ``doc_id`` reachable), ``class_id``.

    ``class_id`` is the least ``doc_id`` with the same set; copies are not expanded into pairs.
    """
    return _grouped(docs, k, percent).select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )


def one_per_group(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``docs`` with one row of each group: the least ``doc_id``, and one without an id only if no row of the group has one.

    Rows are told apart by ``doc_id`` and text: of unlike texts under one ``doc_id``, each is judged in its own group. Of rows equal
    in both, one stays. Documents without a set stay.
    """
    stays = (F.col("stays.doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("stays.text_key") == F.col("text_key"))
    found = _grouped(docs, k, percent).where("node is not null").select("doc_id", "text_key", stays.alias("stays"))
    rows = materialise(found.groupBy("doc_id", "text_key").agg(F.first("stays").alias("stays"), F.count(F.lit(1)).alias("n")))
    keyed = docs.withColumns({"_row_id": F.col("doc_id").cast("long"), "_row_text": F.xxhash64("text")})
    mine = ["_row_id", "_row_text"]

    def met(side: DataFrame, condition: str, how: str) -> DataFrame:
        other = rows.where(condition).select(F.col("doc_id").alias("_other_id"), F.col("text_key").alias("_other_text"))
        same = side["_row_id"].eqNullSafe(other["_other_id"]) & (side["_row_text"] == other["_other_text"])
        return side.join(other, same, how)

    kept = met(keyed, "not stays", "left_anti")
    if rows.where("stays and n > 1").isEmpty():
        return kept.drop(*mine)
    once = met(kept, "stays and n > 1", "left_anti")
    repeated = met(kept, "stays and n > 1", "left_semi").dropDuplicates(mine)
    return once.unionByName(repeated).drop(*mine)
