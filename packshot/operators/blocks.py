"""Pictures as blocks: the drawn pixels of one tile of a picture in one row.

A block is ``(keys..., tx, ty, cells)``. A cell is a BIGINT: place in the tile (row * TILE + column) in the
upper 32 bits, then a byte each for red, green, blue and alpha. Places without a cell are not drawn. A
picture may have several blocks for one tile, with different places.

Blocks are what is stored and shuffled between the steps of a picture: one row per picture and tile, or
per picture, layer and tile. The kernels take whole Arrow batches of blocks, whose size Spark bounds in
bytes, and treat all their pixels at once. Steps that need all blocks of a picture or tile read them in
sorted order and hold one picture or tile beyond a batch (:func:`whole_groups`).

Task code of this module is pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE = 128
TILE_KEYS = ["tx", "ty"]
#: pixels a kernel takes at a time
SLICE = 1 << 18
WHITE = 0xFFFFFF
#: one opaque white cell at the first place, as SQL
BLANK = "array(4294967295L)"


# between pixel rows and blocks


def cell(tile: int = TILE) -> Column:
    """The cell of a pixel row ``x, y, r, g, b, a``."""
    place = f"((y % {tile}) * {tile} + x % {tile})"
    return F.expr(f"shiftleft(cast({place} as bigint), 32) + shiftleft(cast(r as bigint), 24) + g * 65536 + b * 256 + a")


def pack(raster: DataFrame, keys: list[str], tile: int = TILE) -> DataFrame:
    """Blocks of pixel rows ``(keys..., x, y, r, g, b, a)``.

    For tables that come as pixels; one shuffle. Copies of a pixel count once, and of different pixels
    at one place the one whose blue, green, red, alpha come first counts.
    """
    div = lambda c: F.expr(f"cast({c} div {tile} as int)")
    order = F.expr("cast(b as bigint) * 16777216 + g * 65536 + r * 256 + a")
    place = F.expr(f"shiftleft(cast((y % {tile}) * {tile} + x % {tile} as bigint), 32)")
    sets = raster.groupBy(*keys, div("x").alias("tx"), div("y").alias("ty")).agg(F.sort_array(F.collect_set(place + order)).alias("s"))
    first = "filter(s, (e, i) -> i = 0 or shiftright(e, 32) != shiftright(s[greatest(i - 1, 0)], 32))"
    turned = f"""transform({first}, e -> shiftleft(shiftright(e, 32), 32) + shiftleft(shiftright(e, 8) & 255, 24)
        + (shiftright(e, 16) & 255) * 65536 + (shiftright(e, 24) & 255) * 256 + (e & 255))"""
    return sets.select(*keys, "tx", "ty", F.expr(turned).alias("cells"))


def pixels(blocks: DataFrame, keys: list[str], alpha: bool = True, tile: int = TILE) -> DataFrame:
    """Pixel rows ``(keys..., x, y, r, g, b[, a])`` of blocks; no shuffle."""
    rows = blocks.select(*keys, "tx", "ty", F.explode("cells").alias("_c"))
    place = "shiftright(_c, 32)"
    byte = lambda s: F.expr(f"cast(shiftright(_c, {s}) & 255 as int)")
    return rows.select(
        *keys,
        F.expr(f"cast(tx * {tile} + {place} % {tile} as int)").alias("x"),
        F.expr(f"cast(ty * {tile} + {place} div {tile} as int)").alias("y"),
        byte(24).alias("r"), byte(16).alias("g"), byte(8).alias("b"), *([byte(0).alias("a")] if alpha else []),
    )


def types_of(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


# arrays of an Arrow batch


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and the row of each."""
    offsets = column.offsets.to_numpy()
    values = column.flatten().to_numpy()
    return values, np.repeat(np.arange(len(column)), np.diff(offsets))


def _as_lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A list column of ``values`` that are cut at ``starts`` (the first is 0)."""
    offsets = np.append(starts, len(values)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _slices(batch: pa.RecordBatch, cells: str = "cells", weight: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about :data:`SLICE` cells (or weights), one row at least."""
    sizes = np.diff(batch.column(cells).offsets.to_numpy()) if weight is None else weight
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
        yield batch.slice(at, to - at)
        at = to


def changes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """The rows at which one of ``keys`` differs from the row before (row 0 is one)."""
    import pyarrow.compute as pc

    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for k in keys:
        column = batch.column(k)
        a, b = column.slice(1), column.slice(0, len(column) - 1)
        differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        nulls = column.is_null().to_numpy(zero_copy_only=False)
        new[1:] |= differ | (nulls[1:] != nulls[:-1])
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in batches that end with a group: a group of equal ``keys`` is never cut."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        joined = pa.concat_batches([*kept, batch]) if kept else batch
        last = int(changes(joined, keys)[-1])
        if last:
            yield joined.slice(0, last)
        kept = [joined.slice(last)]
    if kept:
        yield kept[0]


def sorted_groups(df: DataFrame, by: list[str], order: list[str], tasks: int | None = None) -> DataFrame:
    """Rows of a group in one task, groups one after the other, sorted inside."""
    dealt = df.repartition(tasks, *by) if tasks else df.repartition(*by)
    return dealt.sortWithinPartitions(*by, *order)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])) if len(sorted_values) else np.zeros(0, np.int64)


# resampling


def resample(rows: DataFrame, keys: list[str], canvas: int, tile: int = TILE) -> DataFrame:
    """Blocks ``(keys..., tx, ty, cells)`` of scaled cut-outs.

    Each row is a block of a cut-out with the placement of a layer: ``left, top`` on the canvas, the box
    ``min_x, max_x, min_y, max_y`` (both edges included), its size ``src_w, src_h`` and its scaled size ``out_w,
    out_h``. Target ``t`` of ``out`` takes source ``((2t + 1) * src) div (2 * out)``, the one under its centre, so the
    sources of a block serve a range of targets each; what falls off the canvas is cut.
    """
    names = ["left", "top", "min_x", "max_x", "min_y", "max_y", "src_w", "src_h", "out_w", "out_h"]
    across = -(-canvas // tile)

    def targets(at, src, out, offset):
        """First and behind-last canvas coordinate of source coordinates ``at``."""
        low = -((src - 2 * out * at) // (2 * src)) + offset
        high = -((src - 2 * out * (at + 1)) // (2 * src)) + offset
        return np.maximum(low, 0), np.minimum(high, canvas)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if not whole.num_rows:
                continue
            scale = (np.maximum(whole.column("out_w").to_numpy(), 1) / whole.column("src_w").to_numpy() + 1) * (
                np.maximum(whole.column("out_h").to_numpy(), 1) / whole.column("src_h").to_numpy() + 1
            )
            weight = np.minimum(np.diff(whole.column("cells").offsets.to_numpy()) * scale, canvas * canvas)
            for batch in _slices(whole, weight=weight):
                cells, row = _lists(batch.column("cells"))
                p = {n: batch.column(n).to_numpy().astype(np.int64)[row] for n in names}
                place = cells >> 32
                x = batch.column("tx").to_numpy().astype(np.int64)[row] * tile + place % tile
                y = batch.column("ty").to_numpy().astype(np.int64)[row] * tile + place // tile
                inside = (x >= p["min_x"]) & (x <= p["max_x"]) & (y >= p["min_y"]) & (y <= p["max_y"])
                x0, x1 = targets(x - p["min_x"], p["src_w"], p["out_w"], p["left"])
                y0, y1 = targets(y - p["min_y"], p["src_h"], p["out_h"], p["top"])
                wide = np.where(inside, np.maximum(x1 - x0, 0), 0)
                number = wide * np.maximum(y1 - y0, 0)
                source = np.repeat(np.arange(len(cells)), number)
                k = np.arange(len(source)) - np.repeat(np.cumsum(number) - number, number)
                tx, ty = x0[source] + k % wide[source], y0[source] + k // wide[source]
                group = (row[source] * across + ty // tile) * across + tx // tile
                place = (ty % tile) * tile + tx % tile
                order = np.argsort(group * (tile * tile) + place, kind="stable")
                group = group[order]
                value = (place[order] << 32) | (cells[source[order]] & 0xFFFFFFFF)
                starts = _runs(group)
                if not len(starts):
                    continue
                of = group[starts]
                taken = pa.array(of // (across * across))
                columns = [batch.column(c).take(taken) for c in keys]
                columns += [pa.array((of % across).astype(np.int32)), pa.array((of // across % across).astype(np.int32))]
                yield pa.record_batch([*columns, _as_lists(value, starts)], [*keys, "tx", "ty", "cells"])

    schema = f"{types_of(rows, keys)}, tx int, ty int, cells array<bigint>"
    return rows.select(*keys, "tx", "ty", "cells", *names).mapInArrow(run, schema)


def with_alpha(blocks: DataFrame, alpha: Callable[..., np.ndarray], tile: int = TILE) -> DataFrame:
    """Blocks with a new alpha, a function of the arrays ``x, y, r, g, b, a``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, row = _lists(batch.column("cells"))
            x = batch.column("tx").to_numpy()[row] * tile + (cells >> 32) % tile
            y = batch.column("ty").to_numpy()[row] * tile + (cells >> 32) // tile
            a = alpha(x, y, *((cells >> s) & 255 for s in (24, 16, 8, 0)))
            offsets = batch.column("cells").offsets.to_numpy()
            new = _as_lists((cells & ~np.int64(255)) | (np.asarray(a, np.int64) & 255), (offsets - offsets[0])[:-1])
            columns = [new if n == "cells" else batch.column(n) for n in batch.schema.names]
            yield pa.record_batch(columns, batch.schema.names)

    return blocks.mapInArrow(run, blocks.schema)


# stacking


def _stacked(key: np.ndarray, colour: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Layers over opaque white: each key with the colour that shows. Lower layers come first."""
    order = np.argsort(key, kind="stable")
    key, colour = key[order], colour[order]
    starts = _runs(key)
    depth = np.diff(np.append(starts, len(key)))
    if (colour & 255 == 255).all():  # the highest shows
        return key[starts], colour[starts + depth - 1]
    out = [np.full(len(starts), 255, np.int64) for _ in range(3)]
    for level in range(int(depth.max(initial=0))):
        at = np.flatnonzero(depth > level)
        c = colour[starts[at] + level]
        a = c & 255
        for channel, shift in zip(out, (24, 16, 8), strict=True):
            channel[at] = (((c >> shift) & 255) * a + channel[at] * (255 - a) + 127) // 255
    return key[starts], (out[0] << 24) | (out[1] << 16) | (out[2] << 8) | 255


def stack(layers: DataFrame, key: str, tasks: int | None = None, tile: int = TILE) -> DataFrame:
    """One block per picture and tile of the blocks ``(key, z, tx, ty, cells)`` of its layers, lowest ``z`` first.

    Layers go over opaque white. One shuffle by picture, of blocks; a task holds the layers of one tile.
    """
    area = tile * tile

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, [key, "tx", "ty"]):
            starts = changes(whole, [key, "tx", "ty"])
            group = np.zeros(whole.num_rows, np.int64)
            group[starts[1:]] = 1
            group = np.cumsum(group)
            sizes = np.diff(whole.column("cells").offsets.to_numpy())
            for a, b in group_slices(starts, sizes):
                part = whole.slice(a, b - a)
                cells, row = _lists(part.column("cells"))
                if not len(cells):
                    continue
                found, colour = _stacked(group[a:b][row] * area + (cells >> 32), cells & 0xFFFFFFFF)
                cut = _runs(found // area)
                of = pa.array(starts[found[cut] // area])
                columns = [whole.column(c).take(of) for c in (key, "tx", "ty")]
                yield pa.record_batch([*columns, _as_lists(((found % area) << 32) | colour, cut)], [key, "tx", "ty", "cells"])

    schema = f"{types_of(layers, [key])}, tx int, ty int, cells array<bigint>"
    source = sorted_groups(layers.select(key, "tx", "ty", "z", "cells"), [key], ["tx", "ty", "z"], tasks)
    return source.mapInArrow(run, schema)


def group_slices(starts: np.ndarray, sizes: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Rows of whole groups with about ``most`` cells in all."""
    before = np.append(0, np.cumsum(sizes))
    borders = np.append(starts, len(sizes))
    at = 0
    while at < len(starts):
        to = int(np.searchsorted(before[borders], before[borders[at]] + most, side="right")) - 1
        to = max(at + 1, min(to, len(starts)))
        yield int(borders[at]), int(borders[to])
        at = to


# shrinking


def _block_span(cells: np.ndarray, size: int, side: int) -> np.ndarray:
    """How many of ``side`` columns fall into each column of ``size``."""
    return -(-(cells + 1) * side // size) + (cells * -side // size)


def _cell_sums(key: np.ndarray, channels: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The keys there are (below ``most``), how often each stands there, and the sums of the channels."""
    if most <= 4 * len(key) + (1 << 16):
        n = np.bincount(key, minlength=most)
        found = np.flatnonzero(n)
        return found, n[found], [np.bincount(key, c, minlength=most)[found].astype(np.int64) for c in channels]
    found, back, n = np.unique(key, return_inverse=True, return_counts=True)
    return found, n, [np.bincount(back, c).astype(np.int64) for c in channels]


def shrink(
    blocks: DataFrame, keys: list[str], side: int, sizes: list[int], alpha: bool = False, tile: int = TILE, together: bool = False
) -> DataFrame:
    """Blocks ``(keys..., size, tx, ty, cells)`` of square pictures at each of ``sizes``.

    Averages blocks of pixels and rounds down; pixels that are not drawn count as white (transparent white with
    ``alpha``), cells without any drawn pixel are not drawn. ``size`` equal to ``side`` passes the blocks through. One
    pass over the pixels serves all sizes. The blocks of a picture meet in one shuffle; none is needed
    where they stand ``together``, one after the other in one task, as :func:`stack` gives them. A task holds one picture
    beyond a batch.
    """
    if max(sizes) > side:
        raise ValueError(f"cannot enlarge pictures of side {side} to {max(sizes)}")
    smaller = sorted({s for s in sizes if s != side})

    def shrunk(cells, x, y, group, size):
        """Group, cell and tile of a picture's cells at ``size``, in the order of group and tile."""
        first = int(group[0])
        channels = [((cells >> s) & 255).astype(np.float64) for s in (24, 16, 8, 0)]
        key = ((group - first) * size + y * size // side) * size + x * size // side
        found, n, (r, g, b, a) = _cell_sums(key, channels, (int(group[-1]) - first + 1) * size * size)
        x, y, of = found % size, found // size % size, found // (size * size) + first
        area = _block_span(x, size, side) * _block_span(y, size, side)
        mean = [(v + (area - n) * 255) // area for v in (r, g, b)]
        opaque = a // area if alpha else 255
        return ((y % tile * tile + x % tile) << 32) | (mean[0] << 24) | (mean[1] << 16) | (mean[2] << 8) | opaque, x // tile, y // tile, of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        across = -(-side // tile)
        for whole in whole_groups(batches, keys):
            if side in sizes:
                columns = [whole.column(c) for c in keys] + [pa.array(np.full(whole.num_rows, side, np.int32))]
                offsets = whole.column("cells").offsets.to_numpy()
                same = _as_lists(whole.column("cells").flatten().to_numpy(), (offsets - offsets[0])[:-1])
                yield pa.record_batch([*columns, whole.column("tx"), whole.column("ty"), same], [*keys, "size", "tx", "ty", "cells"])
            starts = changes(whole, keys)
            number = np.zeros(whole.num_rows, np.int64)
            number[starts[1:]] = 1
            number = np.cumsum(number)
            for a, b in group_slices(starts, np.diff(whole.column("cells").offsets.to_numpy())):
                part = whole.slice(a, b - a)
                cells, row = _lists(part.column("cells"))
                if not len(cells):
                    continue
                x = part.column("tx").to_numpy().astype(np.int64)[row] * tile + (cells >> 32) % tile
                y = part.column("ty").to_numpy().astype(np.int64)[row] * tile + (cells >> 32) // tile
                for size in smaller:
                    new, tx, ty, of = shrunk(cells, x, y, number[a:b][row], size)
                    place = (of * across + ty) * across + tx
                    if size > tile:
                        order = np.argsort(place, kind="stable")
                        new, tx, ty, of, place = new[order], tx[order], ty[order], of[order], place[order]
                    cut = _runs(place)
                    columns = [whole.column(c).take(pa.array(starts[of[cut]])) for c in keys]
                    columns += [pa.array(np.full(len(cut), size, np.int32)), *(pa.array(v[cut].astype(np.int32)) for v in (tx, ty))]
                    yield pa.record_batch([*columns, _as_lists(new, cut)], [*keys, "size", "tx", "ty", "cells"])

    source = blocks.select(*keys, "tx", "ty", "cells")
    source = source if together else sorted_groups(source, keys, [])
    return source.mapInArrow(run, f"{types_of(blocks, keys)}, size int, tx int, ty int, cells array<bigint>")


# whole pictures


def assemble(blocks: DataFrame, keys: list[str], channels: int, tile: int = TILE) -> DataFrame:
    """Square pictures of side ``size`` as bytes in B, G, R(, A) order: ``(keys..., size, data)``.

    What is not drawn is white (transparent white with four channels). One shuffle of blocks; a task
    holds the bytes of one picture beyond a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, [*keys, "size"]):
            starts = changes(whole, [*keys, "size"])
            borders = np.append(starts, whole.num_rows)
            sizes = whole.column("size").to_numpy()
            held, first, n_bytes = [], 0, 0
            for i, (a, b) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)):
                part, size = whole.slice(a, b - a), int(sizes[a])
                picture = np.full((size, size, channels), 255, np.uint8)
                picture[..., 3:] = 0
                cells, row = _lists(part.column("cells"))
                x = part.column("tx").to_numpy().astype(np.int64)[row] * tile + (cells >> 32) % tile
                y = part.column("ty").to_numpy().astype(np.int64)[row] * tile + (cells >> 32) // tile
                for c, shift in zip(range(channels), (8, 16, 24, 0)):
                    picture[y, x, c] = (cells >> shift) & 255
                held.append(picture.tobytes())
                n_bytes += len(held[-1])
                if n_bytes > SLICE * 8 or i + 1 == len(starts):
                    rows = pa.array(starts[first : i + 1])
                    columns = [whole.column(c).take(rows) for c in [*keys, "size"]]
                    yield pa.record_batch([*columns, pa.array(held, pa.binary())], [*keys, "size", "data"])
                    held, first, n_bytes = [], i + 1, 0

    source = sorted_groups(blocks.select(*keys, "size", "tx", "ty", "cells"), [*keys, "size"], ["tx", "ty"])
    return source.mapInArrow(run, f"{types_of(blocks, [*keys, 'size'])}, data binary")
