"""4-connected regions of masks, found tile by tile.

The masks of an image are its gray levels: mask ``k`` holds the pixels of level ``k`` and of all levels before
it, so each mask lies inside the next. One more mask, unrelated to them, may follow (the white one). The pixels are
shuffled once, into tiles of fixed size (``tile_pixels``), one packed BIGINT each.

Every tile is labelled on its own, which bounds the work of a task however large an image is. Its pixels and
the links between neighbours are taken in the order of their levels, and regions only grow and join on the way: a
component tree, found in one pass whatever the number of levels. A row of ``tile_regions`` is a node of that tree, a
region from the mask in which it gets its shape (``mask``) to the last before it changes (``until``). It has
the runs on the tile's edge, and on demand the runs of all its pixels, so no later step has to label a tile again.

Regions that touch across tile borders are joined on that small table (``merge_regions``): many images at a time where their
borders are short, else by rounds of joins. A region is named by its first pixel in reading order: row * 2^32 + column.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packshot.operators.blocks import changes, group_slices, sorted_groups, whole_groups
from packshot.operators.skew import find_hot, salted_join
from packshot.runtime import materialise

# task code is pickled by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE = 128
PLACE = ["image_id", "tx", "ty"]
KEYS = ["image_id", "mask"]
#: level of a pixel that no gray mask holds, and the most masks there can be
NO_LEVEL = 255
#: cells labelled at a time
ROUND = 1 << 17
#: border pixels, once per mask, of an image that one task merges; others take rounds of joins
MERGED = 1 << 18
# sides of a tile, as borders name them
LEFT, RIGHT, TOP, BOTTOM = range(4)


@dataclass
class Tiles:
    """Pixels grouped into tiles: ``(image_id, tx, ty, cells)``, one BIGINT per pixel.

    A cell is its place (row * tile + column) in the upper 31 bits, a byte for the level, a byte that says
    whether the pixel is in the last, unrelated mask (``n_masks`` - 1, if ``extra``), and 24 bits of colour.
    """

    table: DataFrame
    n_masks: int
    tile: int
    one_tile: bool
    extra: bool = False


def check_levels(n_masks: int) -> None:
    """A level has to fit a byte."""
    if n_masks > NO_LEVEL:
        raise ValueError(f"{n_masks} masks: the gray cutoff has more steps than a byte counts")


def tile_pixels(
    mask: DataFrame, n_masks: int = 1, max_side: int | None = None, tile: int = TILE, store: bool = False
) -> Tiles:
    """Group mask pixels ``(image_id, x, y)`` into tiles; ``level``, ``extra`` and ``rgb`` are optional columns.

    ``max_side`` is a promise that no image is larger, checked on every pixel; with at most
    ``tile`` no merge is needed and all that follows stays one lazy plan. Without it, or with
    ``store``, the tiles are stored once for the steps that read them.
    """
    check_levels(n_masks)
    one_tile = max_side is not None and max_side <= tile
    if max_side is not None:
        fits = (F.col("x") < max_side) & (F.col("y") < max_side)
        message = F.lit(f"pixel outside the promised {max_side} x {max_side}")
        mask = mask.withColumn("x", F.when(fits, F.col("x")).otherwise(F.raise_error(message).cast("int")))
    place = (F.col("y") % tile) * tile + F.col("x") % tile
    level, extra, rgb = (F.col(c) if c in mask.columns else F.lit(0) for c in ("level", "extra", "rgb"))
    code = ((place.cast("bigint") * 256 + level) * 256 + extra) * (1 << 24) + rgb
    table = (
        mask.groupBy("image_id", F.expr(f"cast(x div {tile} as int)").alias("tx"), F.expr(f"cast(y div {tile} as int)").alias("ty"))
        # a set: copies of a pixel count once, and no list is longer than its tile
        .agg(F.collect_set(code).alias("cells"))
    )
    stored = materialise(table) if store or not one_tile else table
    return Tiles(stored, n_masks, tile, one_tile, "extra" in mask.columns)


@dataclass
class _Part:
    """The pixels of some tiles in the order of tile and place; of several at one place the first by code."""

    row: np.ndarray  # of the batch
    spot: np.ndarray
    x: np.ndarray
    y: np.ndarray
    level: np.ndarray
    extra: np.ndarray
    rgb: np.ndarray
    a: np.ndarray  # neighbours, as places in these arrays
    b: np.ndarray


def _parts(tx: np.ndarray, ty: np.ndarray, cells: pa.Array, tile: int):
    """The tiles of an Arrow batch, about :data:`ROUND` pixels at a time."""
    area = tile * tile
    lengths = np.diff(cells.offsets.to_numpy())
    codes, ends, first = cells.flatten().to_numpy(), np.cumsum(lengths), 0
    while first < len(lengths):
        begin = ends[first] - lengths[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + ROUND, "right")))
        part = codes[begin : ends[last - 1]]
        key = np.repeat(np.arange(first, last), lengths[first:last]) * area + (part >> 40)
        order = np.lexsort((part, key))
        key, part = key[order], part[order]
        one = np.ones(len(key), bool)
        one[1:] = key[1:] != key[:-1]
        key, part = key[one], part[one]
        # neighbours across differ by 1, neighbours below by ``tile``
        across = np.flatnonzero((key[1:] == key[:-1] + 1) & (key[1:] % tile != 0))
        below = np.searchsorted(key, key + tile)
        down = np.flatnonzero((below < len(key)) & (key % area < area - tile))
        down = down[key[below[down]] == key[down] + tile]
        row, spot = key // area, key % area
        x, y = tx[row].astype(np.int64) * tile + spot % tile, ty[row].astype(np.int64) * tile + spot // tile
        level, extra = ((part >> 32) & 255).astype(np.int64), ((part >> 24) & 255) > 0
        a, b = np.concatenate([across, down]), np.concatenate([across + 1, below[down]])
        yield _Part(row, spot, x, y, level, extra, part & 0xFFFFFF, a, b)
        first = last


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (the first pixel of each region, for every pixel) with the regions of ``a`` and ``b`` joined."""
    while True:
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            return root
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        up = root[root]
        while (up != root).any():
            root, up = up, up[up]


def _tree(part: _Part, masks: range):
    """The nodes of the component tree: ``(first mask, last mask, heads, sizes, root, inside)`` as they end.

    ``heads`` are the first pixels of the regions, ``root`` gives every pixel its head and ``inside`` says which
    pixels the masks hold.
    """
    n = len(part.level)
    link = np.maximum(part.level[part.a], part.level[part.b])
    order = np.argsort(link, kind="stable")
    a, b, borders = part.a[order], part.b[order], np.searchsorted(link[order], np.arange(masks.stop + 1))
    present = np.bincount(part.level, minlength=NO_LEVEL + 1)
    root, since, sizes = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    inside = np.zeros(n, bool)
    for m in masks:
        if not present[m]:
            continue  # nothing changes: links of a level have a pixel of it
        grown = _join(root.copy(), a[borders[m] : borders[m + 1]], b[borders[m] : borders[m + 1]])
        now = part.level <= m
        new = np.bincount(grown[now], minlength=n)
        ended = np.flatnonzero((sizes > 0) & (new != sizes))
        for first in np.unique(since[ended]):
            heads = ended[since[ended] == first]
            yield int(first), m - 1, heads, sizes[heads], root, inside
        since[new != sizes] = m
        root, sizes, inside = grown, new, now
    alive = np.flatnonzero(sizes > 0)
    for first in np.unique(since[alive]):
        heads = alive[since[alive] == first]
        yield int(first), masks.stop - 1, heads, sizes[heads], root, inside


def _labelled(part: _Part, inside: np.ndarray) -> np.ndarray:
    """The head of every pixel for one mask."""
    both = inside[part.a] & inside[part.b]
    return _join(np.arange(len(inside)), part.a[both], part.b[both])


def _by_head(heads: np.ndarray, root: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pixels ``which`` in the order of their heads, and the offsets of those of each of ``heads``."""
    owner = root[which]
    at = np.searchsorted(heads, owner)
    mine = at < len(heads)
    mine[mine] = heads[at[mine]] == owner[mine]
    which, at = which[mine], at[mine]
    order = np.argsort(at, kind="stable")
    return which[order], np.searchsorted(at[order], np.arange(len(heads) + 1))


def _pixel_runs(part: _Part, which: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """``(y, x, n)`` runs of pixels side by side, a list per region."""
    x, y = part.x[which], part.y[which]
    new = np.ones(len(which), bool)
    new[1:] = (y[1:] != y[:-1]) | (x[1:] != x[:-1] + 1)
    new[offsets[:-1][offsets[:-1] < len(which)]] = True
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(which)))
    columns = [pa.array(y[starts].astype(np.int32)), pa.array(x[starts].astype(np.int32)), pa.array(lengths.astype(np.int32))]
    cut = np.searchsorted(starts, offsets).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays(columns, ["y", "x", "n"]))


def _border_runs(part: _Part, heads: np.ndarray, root: np.ndarray, inside: np.ndarray, tile: int, skip: bool) -> pa.Array:
    """``(side, low, high)`` runs of a region's pixels on the sides of its tile, a list per region."""
    found = [[], [], [], []]
    for side, (fixed, at, along) in enumerate(
        ((part.x, 0, part.y), (part.x, tile - 1, part.y), (part.y, 0, part.x), (part.y, tile - 1, part.x))
    ):
        # no tile lies before the first column or row
        meets = (fixed % tile == at) & ((fixed > 0) | (side in (RIGHT, BOTTOM)))
        which = np.flatnonzero(inside & meets) if not skip else np.zeros(0, np.int64)
        which, offsets = _by_head(heads, root, which)
        owner = np.repeat(np.arange(len(heads)), np.diff(offsets))
        order = np.lexsort((along[which], owner))
        owner, place = owner[order], along[which][order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(owner)) - 1
        for held, values in zip(found, (owner[starts], np.full(len(starts), side), place[starts], place[ends] if len(starts) else place[:0]), strict=True):
            held.append(values)
    owner, side, low, high = (np.concatenate(f) for f in found)
    order = np.argsort(owner, kind="stable")
    columns = [pa.array(v[order].astype(np.int32)) for v in (side, low, high)]
    offsets = np.searchsorted(owner[order], np.arange(len(heads) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, ["side", "low", "high"]))


def tile_regions(tiles: Tiles, runs: bool = False) -> DataFrame:
    """``(image_id, tx, ty, mask, until, region, size, border[, runs])`` per node of the trees of the tiles.

    ``border`` has the runs on the tile's edge; it is empty where no merge is needed. ``runs``: ``(y, x, n)`` of all pixels.
    """
    tile, one_tile, n_masks, extra = tiles.tile, tiles.one_tile, tiles.n_masks, tiles.extra

    def nodes(part):
        yield from _tree(part, range(n_masks - extra))
        if extra:
            root = _labelled(part, part.extra)
            sizes = np.bincount(root[part.extra], minlength=len(root))
            heads = np.flatnonzero(sizes)
            yield n_masks - 1, n_masks - 1, heads, sizes[heads], root, part.extra

    def find(batches):
        for batch in batches:
            ids, tx, ty, cells = (batch.column(i) for i in range(4))
            for part in _parts(tx.to_numpy(), ty.to_numpy(), cells, tile):
                for first, last, heads, sizes, root, inside in nodes(part):
                    rows = pa.array(part.row[heads])
                    name = (part.y[heads] << 32) + part.x[heads]
                    columns = [ids.take(rows), tx.take(rows), ty.take(rows)]
                    columns += [pa.array(np.full(len(heads), m, np.int32)) for m in (first, last)]
                    columns += [pa.array(name), pa.array(sizes.astype(np.int64))]
                    columns.append(_border_runs(part, heads, root, inside, tile, one_tile))
                    if runs:
                        columns.append(_pixel_runs(part, *_by_head(heads, root, np.flatnonzero(inside))))
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = [*PLACE, "mask", "until", "region", "size", "border", *(["runs"] if runs else [])]
    id_type = tiles.table.schema["image_id"].dataType.simpleString()
    schema = f"image_id {id_type}, tx int, ty int, mask int, until int, region bigint, size bigint, border array<struct<side:int,low:int,high:int>>"
    if runs:
        schema += ", runs array<struct<y:int,x:int,n:int>>"
    return tiles.table.select(*PLACE, "cells").mapInArrow(find, schema)


def paint(tiles: Tiles, values: DataFrame, only: int | None = None) -> DataFrame:
    """Blocks ``(image_id, tx, ty, min_x, max_x, min_y, max_y, cells)`` of the pixels in the regions of ``values``.

    ``values`` is ``(image_id, mask, region, value)`` by tile region, of one gray mask per image and the extra one;
    a pixel in both gets the sum of the values (below 256). A cell has its value where blocks have their alpha. ``only`` keeps
    the pixels of that value, as opaque cells. The box is that of the cells.
    """
    tile, n_masks, extra = tiles.tile, tiles.n_masks, tiles.extra

    def held(part, mask, region, value, owner, inside, which):
        """Sum of the values for each pixel, by the regions that ``which`` picks."""
        root = _labelled(part, inside)
        first = owner[which] * (tile * tile) + (region[which] >> 32) % tile * tile + (region[which] & 0xFFFFFFFF) % tile
        order = np.argsort(first)
        known, amount = first[order], value[which][order]
        asked = part.row[root] * (tile * tile) + part.spot[root]
        at = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
        hit = inside & (known[at] == asked) if len(known) else np.zeros(len(asked), bool)
        return np.where(hit, amount[at] if len(known) else 0, 0)

    def spread(batches):
        for batch in batches:
            ids, tx, ty, cells, wanted = (batch.column(i) for i in range(5))
            owner = np.repeat(np.arange(len(ids)), np.diff(wanted.offsets.to_numpy()))
            mask, region, value = (c.to_numpy() for c in wanted.flatten().flatten())
            gray = mask < n_masks - extra
            level = np.full(len(ids), -1, np.int64)
            level[owner[gray]] = mask[gray]
            for part in _parts(tx.to_numpy(), ty.to_numpy(), cells, tile):
                total = held(part, mask, region, value, owner, part.level <= level[part.row], gray)
                if extra:
                    total += held(part, mask, region, value, owner, part.extra, ~gray)
                at = np.flatnonzero(total == only if only is not None else total > 0)
                if not len(at):
                    continue
                row = part.row[at]
                starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                last = np.full(len(at), 255) if only is not None else total[at]
                code = (part.spot[at] << 32) | (part.rgb[at] << 8) | last
                boxes = [f.reduceat(v[at], starts).astype(np.int32) for v in (part.x, part.y) for f in (np.minimum, np.maximum)]
                of = pa.array(row[starts])
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(at)).astype(np.int32)), pa.array(code))
                columns = [ids.take(of), tx.take(of), ty.take(of), *map(pa.array, boxes), lists]
                yield pa.RecordBatch.from_arrays(columns, [*PLACE, "min_x", "max_x", "min_y", "max_y", "cells"])

    def tile_of(coordinate: str):
        return F.expr(f"cast(({coordinate}) div {tile} as int)")

    by_tile = (
        values.withColumn("tx", tile_of("region & 4294967295"))
        .withColumn("ty", tile_of("shiftright(region, 32)"))
        .groupBy(*PLACE)
        .agg(F.collect_set(F.struct("mask", "region", F.col("value").cast("bigint").alias("value"))).alias("wanted"))
    )
    id_type = tiles.table.schema["image_id"].dataType.simpleString()
    joined = tiles.table.join(by_tile, PLACE).select(*PLACE, "cells", "wanted")
    schema = f"image_id {id_type}, tx int, ty int, min_x int, max_x int, min_y int, max_y int, cells array<bigint>"
    return joined.mapInArrow(spread, schema)


def merge_regions(tiles: Tiles, regions: DataFrame) -> DataFrame:
    """``regions`` with ``label`` and ``total``: the region that each tile region is part of, and its size.

    ``label`` is the smallest name among the joined tile regions. What the nodes on a tile's edge join changes from
    mask to mask, so they come back in several rows of fewer masks; others stay nodes. Images with more than :data:`MERGED`
    border pixels are merged by joins, so that no task holds one of them.
    """
    alone = [F.col("region").alias("label"), F.col("size").alias("total")]
    if tiles.one_tile:
        return regions.select("*", *alone).drop("border")
    regions = materialise(regions)
    inner = regions.where(F.size("border") == 0).select("*", *alone).drop("border")
    outer = regions.where(F.size("border") > 0)
    weighed = outer.withColumn("places", F.expr("(until - mask + 1) * aggregate(border, 0L, (n, e) -> n + e.high - e.low + 1)"))
    sizes = weighed.groupBy("image_id").agg(F.sum("places").alias("places"))
    large = materialise(sizes.where(F.col("image_id").isNull() | (F.col("places") > MERGED)).select("image_id", F.lit(True).alias("_large")))
    if large.isEmpty():
        return inner.unionByName(_merged_images(weighed, tiles.tile))
    if not large.where("image_id is null").isEmpty():  # a NULL id links nothing
        return inner.unionByName(_merged_by_joins(outer))
    known = salted_join(weighed, large, ["image_id"], find_hot(outer, ["image_id"]), F.xxhash64("mask", "region"), "left")
    small, rest = known.where("_large is null").drop("_large"), known.where("_large").drop("_large", "places")
    return inner.unionByName(_merged_images(small, tiles.tile)).unionByName(_merged_by_joins(rest))


def _merged_images(outer: DataFrame, tile: int) -> DataFrame:
    """``outer`` with ``label`` and ``total``; the nodes of an image meet in one task, many images at a time.

    Masks with equal results stay one row. Rows of one region (an id that two images have) meet each other, as in a join.
    """
    columns = [c for c in outer.columns if c not in ("border", "places")]

    def merge(batches):
        for whole in whole_groups(batches, ["image_id"]):
            starts = changes(whole, ["image_id"])
            image = np.zeros(whole.num_rows, np.int64)
            image[starts[1:]] = 1
            image = np.cumsum(image)
            for a, b in group_slices(starts, whole.column("places").to_numpy(), MERGED):
                part = whole.slice(a, b - a)
                mask, until, region, size = (part.column(c).to_numpy().astype(np.int64) for c in ("mask", "until", "region", "size"))
                # a node once per mask
                n_masks = until - mask + 1
                first = np.cumsum(n_masks) - n_masks
                row = np.repeat(np.arange(len(mask)), n_masks)
                own_mask = np.arange(len(row)) - first[row] + mask[row]
                group = image[a:b][row] * 256 + own_mask
                # equal regions of a mask are one; the order of their numbers is that of their names
                named = region[row]
                order = np.lexsort((named, group))
                new = np.ones(len(order), bool)
                new[1:] = (group[order][1:] != group[order][:-1]) | (named[order][1:] != named[order][:-1])
                number = np.empty(len(order), np.int64)
                number[order] = np.cumsum(new) - 1
                names, groups = named[order][new], group[order][new]
                near, far = _links(part, n_masks, first, number, group)
                of = _join(np.arange(len(names)), near, far)[number]
                linked = np.zeros(image[b - 1] + 1, bool)
                linked[groups[near] >> 8] = True
                linked = linked[group >> 8]
                label = names[of]
                total = np.where(linked, np.bincount(of, size[row], len(names)).astype(np.int64)[of], size[row])
                copies = np.where(linked, np.bincount(number)[number], 1)
                # masks of a node with equal results
                cut = np.ones(len(row), bool)
                cut[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1]) | (total[1:] != total[:-1]) | (copies[1:] != copies[:-1])
                cut = np.flatnonzero(cut)
                last = np.append(cut[1:], len(row)) - 1
                cut, last = np.repeat(cut, copies[cut]), np.repeat(last, copies[cut])
                taken = pa.array(row[cut])
                values = {"mask": pa.array(own_mask[cut].astype(np.int32)), "until": pa.array(own_mask[last].astype(np.int32))}
                held = [values[c] if c in values else part.column(c).take(taken) for c in columns]
                yield pa.RecordBatch.from_arrays([*held, pa.array(label[cut]), pa.array(total[cut])], [*columns, "label", "total"])

    schema = ", ".join(f"`{c}` {outer.schema[c].dataType.simpleString()}" for c in columns)
    source = sorted_groups(outer, ["image_id"], [])
    return source.mapInArrow(merge, f"{schema}, label bigint, total bigint")


def _links(part: pa.RecordBatch, n_masks: np.ndarray, first: np.ndarray, number: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the regions with neighbouring pixels on both sides of a line between tiles.

    The runs on the sides are taken pixel by pixel and mask by mask; ``first`` is the first mask of a row in ``number`` and ``group``.
    """
    border = part.column("border")
    owner = np.repeat(np.arange(len(border)), np.diff(border.offsets.to_numpy()))
    side, low, high = (c.to_numpy().astype(np.int64) for c in border.flatten().flatten())
    along = side // 2  # LEFT and RIGHT, or TOP and BOTTOM
    line = np.where(along == 0, part.column("tx").to_numpy()[owner], part.column("ty").to_numpy()[owner]) + side % 2
    run = np.repeat(np.arange(len(owner)), n_masks[owner])
    node = first[owner][run] + np.arange(len(run)) - np.repeat(np.cumsum(n_masks[owner]) - n_masks[owner], n_masks[owner])
    _, place = np.unique(((group[node] * 2 + along[run]) << 32) + line[run], return_inverse=True)
    length = (high - low + 1)[run]
    pixel = np.repeat(np.arange(len(run)), length)
    at = low[run][pixel] + np.arange(len(pixel)) - np.repeat(np.cumsum(length) - length, length)
    key, node, before = (place[pixel] << 32) + at, number[node][pixel], side[run][pixel] % 2 == 1
    order = np.argsort(key[~before], kind="stable")
    known, asked = key[~before][order], key[before]
    begin, end = np.searchsorted(known, asked), np.searchsorted(known, asked, "right")
    met = end - begin
    far = np.repeat(begin, met) + np.arange(met.sum()) - np.repeat(np.cumsum(met) - met, met)
    return np.repeat(node[before], met), node[~before][order][far]


def _merged_by_joins(outer: DataFrame) -> DataFrame:
    """``outer`` with ``label`` and ``total``, once per mask (``until`` = ``mask``), for images of any size."""
    alone = [F.col("region").alias("label"), F.col("size").alias("total")]
    outer = outer.withColumn("mask", F.explode(F.sequence("mask", "until"))).withColumn("until", F.col("mask"))
    links = materialise(_border_links(outer))
    outer = outer.drop("border")
    if links.isEmpty():
        return outer.select("*", *alone)
    narrow = outer.select(*KEYS, "region", "size").join(_merged_labels(links).hint("merge"), [*KEYS, "region"], "left")
    labels = materialise(narrow.withColumn("label", F.coalesce("label", "region")))
    on = [*KEYS, "label"]
    totals = labels.groupBy(*on).agg(F.sum("size").alias("total"))
    # very many tile regions may share a label: the background of a large image, say
    merged = salted_join(labels, totals.hint("merge"), on, find_hot(labels, on), F.xxhash64("region")).select(*KEYS, "region", "label", "total")
    return outer.join(merged.hint("merge"), [*KEYS, "region"])


def _border_links(outer: DataFrame) -> DataFrame:
    """Pairs of tile regions with neighbouring pixels, in both directions: ``(image_id, mask, region, other)``.

    The runs on facing sides of two tiles meet where they overlap.
    """
    edge = outer.select(*KEYS, "tx", "ty", "region", F.explode("border").alias("e")).select(*KEYS, "tx", "ty", "region", "e.*")
    pairs = []
    for near, far, along in ((RIGHT, LEFT, "tx"), (BOTTOM, TOP, "ty")):
        before = edge.where(F.col("side") == near).withColumn(along, F.col(along) + 1).drop("side")
        after = edge.where(F.col("side") == far).select(
            *KEYS, "tx", "ty", F.col("region").alias("other"), F.col("low").alias("low2"), F.col("high").alias("high2")
        )
        met = before.join(after.hint("merge"), [*KEYS, "tx", "ty"]).where((F.col("low") <= F.col("high2")) & (F.col("low2") <= F.col("high")))
        pairs.append(met.select(*KEYS, "region", "other"))
    one_way = pairs[0].unionAll(pairs[1])
    both = F.explode(F.array(F.struct("region", "other"), F.struct(F.col("other").alias("region"), F.col("region").alias("other"))))
    return one_way.select(*KEYS, both.alias("link")).select(*KEYS, "link.region", "link.other").distinct()


def _merged_labels(links: DataFrame) -> DataFrame:
    """``(image_id, mask, region, label)``: smallest region name of each linked group.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    long chains close quickly. The rounds stop when no label changes.
    """
    labels = materialise(links.groupBy(*KEYS, "region").agg(F.min(F.least("region", "other")).alias("label")))
    # links to a region that touches very many others are spread over several tasks
    hub = find_hot(links, [*KEYS, "other"])
    while True:
        # joins of tables that grow with the input: never by way of the driver
        seen = labels.select(*KEYS, F.col("region").alias("other"), F.col("label").alias("near")).hint("merge")
        near = (
            salted_join(links, seen, [*KEYS, "other"], hub, F.xxhash64("region"))
            .groupBy(*KEYS, "region")
            .agg(F.min("near").alias("near"))
        )
        lower = materialise(
            labels.join(near.hint("merge"), [*KEYS, "region"]).select(
                *KEYS, "region", F.col("label").alias("old"), F.least("label", "near").alias("label")
            )
        )
        if lower.where(F.col("label") != F.col("old")).isEmpty():
            return labels
        on = [*KEYS, "label"]
        jump = lower.select(*KEYS, F.col("region").alias("label"), F.col("label").alias("next")).hint("merge")
        labels = materialise(
            salted_join(lower, jump, on, find_hot(lower, on), F.xxhash64("region")).select(
                *KEYS, "region", F.least("label", "next").alias("label")
            )
        )


def regions(mask: DataFrame, max_side: int | None = None, tile: int = TILE) -> DataFrame:
    """``(image_id, region, size)``: the regions of one mask ``(image_id, x, y)``."""
    tiles = tile_pixels(mask, 1, max_side, tile)
    merged = merge_regions(tiles, tile_regions(tiles))
    if not tiles.one_tile:
        merged = merged.where(F.col("region") == F.col("label"))
    return merged.select("image_id", F.col("label").alias("region"), F.col("total").alias("size"))


def _run_pixels(regions: DataFrame) -> DataFrame:
    """``(image_id, x, y, region)`` of the runs of labelled regions; no shuffle."""
    run = regions.select("image_id", "label", F.explode("runs").alias("r"))
    x = F.explode(F.sequence(F.col("r.x"), F.col("r.x") + F.col("r.n") - 1))
    return run.select("image_id", x.alias("x"), F.col("r.y").alias("y"), F.col("label").alias("region"))


def region_pixels(mask: DataFrame, max_side: int | None = None, tile: int = TILE) -> DataFrame:
    """``(image_id, x, y, region)``: every mask pixel with its region."""
    tiles = tile_pixels(mask, 1, max_side, tile)
    return _run_pixels(merge_regions(tiles, tile_regions(tiles, runs=True)))


def filter_mask(
    mask: DataFrame, totals: DataFrame, size_cutoff: float, max_side: int | None = None, tile: int = TILE
) -> DataFrame:
    """``(image_id, x, y, region)``: the mask without its small regions.

    A region stays if it has more than ``size_cutoff`` of all pixels of its image; ``totals`` is
    ``(image_id, n_pixels)``. The regions carry their runs: the tiles are read and labelled once.
    """
    tiles = tile_pixels(mask, 1, max_side, tile)
    merged = materialise(merge_regions(tiles, tile_regions(tiles, runs=True)))
    hot = find_hot(merged, ["image_id"])
    sized = salted_join(merged, totals.select("image_id", "n_pixels"), ["image_id"], hot, F.xxhash64("region"))
    return _run_pixels(sized.where(F.col("total") > F.col("n_pixels") * F.lit(size_cutoff)))
