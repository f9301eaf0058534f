"""Raster operators against plain definitions on small images."""

import collections
import random

import numpy as np
import pytest

from packshot.operators import compose, layers, raster, regions, silhouette
from packshot.sources.layouts import ImageSettings

PIXEL = "image_id string, x int, y int, r int, g int, b int, a int"


def grid(seed, h, w, p):
    draw = random.Random(seed)
    return np.array([[draw.random() < p for _ in range(w)] for _ in range(h)])


def mask_rows(masks):
    return [(k, int(x), int(y)) for k, m in masks.items() for y, x in zip(*np.nonzero(m))]


def flood(mask):
    """{(x, y): (first pixel in reading order, size)}, by breadth-first search."""
    left, found = {(int(x), int(y)) for y, x in zip(*np.nonzero(mask))}, {}
    for start in sorted(left, key=lambda p: (p[1], p[0])):
        if start in found:
            continue
        part, queue = [], collections.deque([start])
        seen = {start}
        while queue:
            x, y = queue.popleft()
            part.append((x, y))
            for p in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if p in left and p not in seen:
                    seen.add(p)
                    queue.append(p)
        found |= {p: (start, len(part)) for p in part}
    return found


@pytest.fixture(scope="module")
def masks():
    snake = np.zeros((13, 11), bool)
    snake[::2] = True
    snake[1::4, -1] = snake[3::4, 0] = True
    return {
        "half": grid(1, 9, 14, 0.5),
        "dense": grid(2, 12, 12, 0.62),
        "all": np.ones((10, 7), bool),
        "snake": snake,
        "dot": np.eye(1, 1, dtype=bool),
        "none": np.zeros((3, 3), bool),
    }


@pytest.mark.parametrize("how", [{"max_side": 14}, {"tile": 4}, {"tile": 3}, {}, {"max_side": 14, "tile": 5}])
def test_regions_do_not_depend_on_tiles(spark, masks, how):
    df = spark.createDataFrame(mask_rows(masks), "image_id string, x int, y int")
    pixels = {(r.image_id, r.x, r.y): r.region for r in regions.region_pixels(df, **how).collect()}
    want = {(k, *p): (y << 32) + x for k, m in masks.items() for p, ((x, y), _) in flood(m).items()}
    assert pixels == want
    table = sorted(tuple(r) for r in regions.regions(df, **how).collect())
    assert table == sorted({(k, (y << 32) + x, n) for k, m in masks.items() for (x, y), n in flood(m).values()})


@pytest.mark.parametrize("how", [{"max_side": 14}, {"tile": 4}])
def test_small_regions_are_dropped(spark, masks, how):
    df = spark.createDataFrame(mask_rows(masks), "image_id string, x int, y int")
    totals = spark.createDataFrame([(k, m.size) for k, m in masks.items()], "image_id string, n_pixels long")
    found = {tuple(r) for r in regions.filter_mask(df, totals, 0.04, **how).collect()}
    assert found == {
        (k, *p, (y << 32) + x) for k, m in masks.items() for p, ((x, y), n) in flood(m).items() if n > m.size * 0.04
    }


def test_filtered_masks_do_not_move_tiles_again(spark, masks):
    df = spark.createDataFrame(mask_rows(masks), "image_id string, x int, y int")
    totals = spark.createDataFrame([(k, m.size) for k, m in masks.items()], "image_id string, n_pixels long")
    for how in ({"max_side": 14}, {"tile": 4}):
        plan = regions.filter_mask(df, totals, 0.04, **how)._jdf.queryExecution().executedPlan().toString()
        assert "cells" not in plan and "MapInArrow" not in plan  # runs of stored regions


@pytest.mark.parametrize("seed", range(4))
def test_component_tree_at_every_level(spark, seed):
    """Every region of every mask, in tiles that cut them."""
    rng = np.random.default_rng(seed)
    levels = {"a": rng.integers(0, 12, (11, 13)), "b": rng.choice([0, 3, 200, 255], (9, 8))}
    data = [(k, int(x), int(y), int(v[y, x]), int((x + y) % 3 == 0)) for k, v in levels.items() for y in range(v.shape[0]) for x in range(v.shape[1])]
    df = spark.createDataFrame(data, "image_id string, x int, y int, level int, extra int")
    for how in ({"tile": 4}, {"max_side": 13}):
        tiles = regions.tile_pixels(df, 13, **how)
        found = regions.merge_regions(tiles, regions.tile_regions(tiles, runs=True)).collect()
        for k, v in levels.items():
            for mask in range(13):
                inside = v <= mask if mask < 12 else np.add.outer(np.arange(v.shape[0]), np.arange(v.shape[1])) % 3 == 0
                got = {}
                for r in found:
                    if r.image_id == k and r.mask <= mask <= r.until:
                        assert sum(e.n for e in r.runs) == r.size
                        got |= {(e.x + i, e.y): ((r.label & 0xFFFFFFFF, r.label >> 32), r.total) for e in r.runs for i in range(e.n)}
                assert got == flood(inside)


def test_more_levels_than_a_byte_counts(spark):
    with pytest.raises(ValueError, match="masks"):
        regions.tile_pixels(spark.createDataFrame([("i", 0, 0)], "image_id string, x int, y int"), 300)


def test_copies_of_a_pixel_count_once(spark, masks):
    once = spark.createDataFrame(mask_rows({"half": masks["half"]}), "image_id string, x int, y int")
    assert sorted(regions.regions(once.union(once), 14).collect()) == sorted(regions.regions(once, 14).collect())


def test_hot_regions_are_merged_alike(spark, masks, monkeypatch):
    real = regions.find_hot
    monkeypatch.setattr(regions, "find_hot", lambda df, on: real(df, on, share=50, rows=3))
    df = spark.createDataFrame(mask_rows(masks), "image_id string, x int, y int")
    table = sorted(tuple(r) for r in regions.regions(df, tile=3).collect())
    assert table == sorted({(k, (y << 32) + x, n) for k, m in masks.items() for (x, y), n in flood(m).values()})


@pytest.mark.parametrize("limit", [0, 70])
@pytest.mark.parametrize("hot", [False, True])
def test_large_images_are_merged_by_joins(spark, masks, monkeypatch, limit, hot):
    monkeypatch.setattr(regions, "MERGED", limit)
    if hot:
        real = regions.find_hot
        monkeypatch.setattr(regions, "find_hot", lambda df, on: real(df, on, share=50, rows=3))
    df = spark.createDataFrame(mask_rows(masks), "image_id string, x int, y int")
    table = sorted(tuple(r) for r in regions.regions(df, tile=3).collect())
    assert table == sorted({(k, (y << 32) + x, n) for k, m in masks.items() for (x, y), n in flood(m).values()})


def test_regions_meet_without_the_driver(spark, masks, monkeypatch):
    df = spark.createDataFrame(mask_rows(masks), "image_id string, x int, y int")
    stored = []
    real = regions.materialise
    monkeypatch.setattr(regions, "materialise", lambda df: stored.append(df) or real(df))
    regions.regions(df, tile=4).collect()
    assert len(stored) == 3  # tiles, their regions, and the images that are too large: no rounds
    monkeypatch.setattr(regions, "MERGED", 0)
    regions.regions(df, tile=4).collect()
    labels = [s for s in stored if "label" in s.columns and "size" not in s.columns]
    assert len(labels) > 2 and not any("BroadcastHashJoin" in s._jdf.queryExecution().executedPlan().toString() for s in labels)


def test_a_border_pixel_is_in_few_rows(spark):
    """An image that is one region from its first level to its last."""
    df = spark.createDataFrame([("i", x, y, 0) for x in range(8) for y in range(8)], "image_id string, x int, y int, level int")
    tiles = regions.tile_pixels(df, 50, tile=4)
    found = regions.merge_regions(tiles, regions.tile_regions(tiles)).collect()
    assert len(found) == 4 and {(r.mask, r.until, r.label, r.total) for r in found} == {(0, 49, 0, 64)}


def test_a_broken_promise_raises(spark):
    df = spark.createDataFrame([("i", 9, 0)], "image_id string, x int, y int")
    with pytest.raises(Exception, match="outside the promised 8 x 8"):
        regions.regions(df, max_side=8).collect()


def test_gray_values(spark, rows):
    df = spark.createDataFrame(
        [("i", 0, 0, 255, 255, 255, 255), ("i", 1, 0, 0, 0, 0, 255), ("i", 2, 0, 254, 255, 255, 255), ("i", 3, 0, 242, 242, 242, 255)], PIXEL
    )
    assert rows(raster.gray(df, ImageSettings((8,), "png", 1, 1))) == [
        ("i", 0, 0, 2550000, True, False),
        ("i", 1, 0, 0, False, True),
        ("i", 2, 0, 2547875, False, False),
        ("i", 3, 0, 2420000, False, True),
    ]


def images(seed=5):
    draw = random.Random(seed)
    white = np.full((8, 8, 3), 255)
    pale = white.copy()
    pale[2:6, 2:6] = 249
    dark = white.copy()
    dark[1:7, 2:7] = [10, 200, 30]
    dark[0, 0] = 0
    noise = np.array([[[draw.choice([0, 200, 243, 247, 250, 255])] * 3 for _ in range(9)] for _ in range(6)])
    noise2 = np.array([[[draw.choice([100, 246, 253, 255])] * 3 for _ in range(5)] for _ in range(11)])
    return {"white": white, "pale": pale, "dark": dark, "noise": noise, "noise2": noise2}


def pixel_frame(spark, pictures):
    data = [(k, x, y, *map(int, p[y, x]), 255) for k, p in pictures.items() for y in range(p.shape[0]) for x in range(p.shape[1])]
    return spark.createDataFrame(data, PIXEL)


def silhouette_by_definition(p, s):
    gray = (2125 * p[..., 0] + 7154 * p[..., 1] + 721 * p[..., 2]).astype(int)

    def large(mask):
        out = np.zeros(mask.shape, bool)
        for (x, y), (_, n) in flood(mask).items():
            out[y, x] = n > mask.size * s.silo_filter_size_cutoff
        return out

    k = 0
    while True:
        cutoff = round(s.silo_gray_max_cutoff * 2550000) + 25500 * k
        kept = large(gray <= cutoff)
        if kept.sum() > s.silo_min_img_not_background * kept.size:
            return k, cutoff, int(kept.sum()), large(gray >= s.silo_white_min_cutoff * 2550000) * 1 + kept * 2
        k += 1


@pytest.mark.parametrize(
    "settings",
    [
        ImageSettings((16,), "png", 1, 1),
        ImageSettings((16,), "png", 1, 1, silo_filter_size_cutoff=0.04, silo_min_img_not_background=0.6),
        ImageSettings((16,), "png", 1, 1, silo_gray_max_cutoff=0.9, silo_white_min_cutoff=0.99, silo_filter_size_cutoff=0.03),
        ImageSettings((16,), "png", 1, 1, silo_gray_max_cutoff=0.5, silo_filter_size_cutoff=0.03, silo_min_img_not_background=0.4),
        ImageSettings((16,), "png", 1, 1, silo_gray_max_cutoff=0.05, silo_white_min_cutoff=0.9),
    ],
)
@pytest.mark.parametrize("tiling", [{"max_side": 11}, {"tile": 4}])
def test_cutoffs_and_seeds(spark, settings, tiling):
    pictures = images()
    tiles = silhouette.mask_tiles(pixel_frame(spark, pictures), settings, **tiling)
    found = silhouette.image_regions(tiles)
    cutoffs = {r.image_id: r for r in silhouette.foreground_cutoff(found, settings).collect()}
    seeds = {(r.image_id, r.x, r.y): (r.seed, r.rgb) for r in silhouette.seeds(tiles, found, settings).collect()}
    want = {}
    for k, p in pictures.items():
        level, cutoff, covered, labels = silhouette_by_definition(p, settings)
        got = cutoffs[k]
        assert (got.level, got.cutoff, got.covered, got.n_pixels) == (level, cutoff, covered, labels.size), k
        want |= {
            (k, int(x), int(y)): (int(labels[y, x]), int(p[y, x] @ [65536, 256, 1])) for y, x in zip(*np.nonzero(labels))
        }
    assert seeds == want


def test_a_white_image_has_no_foreground(spark):
    df = pixel_frame(spark, {"white": images()["white"]})
    tiles = silhouette.mask_tiles(df, ImageSettings((16,), "png", 1, 1), 8)
    found = silhouette.seeds(tiles, silhouette.image_regions(tiles), ImageSettings((16,), "png", 1, 1))
    assert {r.seed for r in found.collect()} == {3}
    assert silhouette.foreground(tiles, ImageSettings((16,), "png", 1, 1)).count() == 0


def box(spark, *values):
    names = "oms_id string, product_type string, image_id string, ulx double, uly double, w double, min_x int, max_x int, min_y int, max_y int"
    return spark.createDataFrame([("1", "Saw", "i", *values)], names)


@pytest.mark.parametrize(
    "values, scale",
    [
        ((0.1, 0.4, 0.35, 0, 200, 0, 100), 1.75),
        ((0.1, 0.4, 0.35, 0, 100, 0, 300), 520 / 300),
        ((0.1, 0.4, 0.35, 5, 5, 5, 5), None),
        ((0.1, 0.4, 0.35, 7, 3, 7, 3), -87.5),
    ],
)
def test_placement(spark, values, scale):
    found = raster.placement(box(spark, *values), ImageSettings((40, 1000), "png", 1, 80)).first()
    assert (found.left, found.top, found.width) == (100, 400, 350)
    assert found.scale == (None if scale is None else pytest.approx(scale))


def test_bounding_box_is_eroded(spark):
    df = spark.createDataFrame([("i", 10, 5), ("i", 30, 6), ("i", 20, 40)], "image_id string, x int, y int")
    assert tuple(raster.bounding_box(df, ImageSettings((8,), "png", 3, 0)).first()) == ("i", 13, 27, 8, 37)


@pytest.mark.parametrize("rows_per_task", [1_000_000, 3])
def test_layers_take_the_nearest_pixel(spark, rows_per_task):
    s = ImageSettings((8, 20), "png", 0, 1)
    source = [("i", x, y, 10 * x, 20 * y, 7) for x in range(7) for y in range(5) if (x + y) % 4]
    cut = spark.createDataFrame(source, "image_id string, x int, y int, r int, g int, b int")
    placed = spark.createDataFrame(
        [("1", "Saw", "i", 0.1, 0.2, 0.9, 1, 6, 0, 4), ("2", "Saw", "i", 0.7, 0.7, 0.7, 0, 6, 0, 4), ("3", "Tape", "i", 0.0, 0.0, 0.1, 0, 6, 1, 3),
         ("4", "Tape", "i", 0.0, 0.0, 0.1, 3, 3, 3, 3)],
        "oms_id string, product_type string, image_id string, ulx double, uly double, w double, min_x int, max_x int, min_y int, max_y int",
    )
    placements = raster.placement(placed, s)
    found = {(r.oms_id, r.x, r.y): (r.r, r.g, r.b, r.a) for r in layers.layer_raster(placements, cut, s, rows_per_task).collect()}
    want, colours = {}, {(x, y): (r, g, b, 255) for _, x, y, r, g, b in source}
    for p in placements.where("scale is not null").collect():
        sw, sh = p.max_x - p.min_x + 1, p.max_y - p.min_y + 1
        ow, oh = round(sw * p.scale), round(sh * p.scale)
        for tx in range(ow):
            for ty in range(oh):
                colour = colours.get((p.min_x + (2 * tx + 1) * sw // (2 * ow), p.min_y + (2 * ty + 1) * sh // (2 * oh)))
                x, y = p.left + tx, p.top + ty
                if colour and x < 20 and y < 20:
                    want[p.oms_id, x, y] = colour
    assert found == want and {k[0] for k in want} == {"1", "2", "3"}


def test_one_image_per_layer(spark, rows):
    df = spark.createDataFrame([("1", "Saw", "b"), ("1", "Saw", "a"), ("1", "Tape", "b")], "oms_id string, product_type string, image_id string")
    assert rows(layers.one_image_per_layer(df)) == [("1", "Saw", "a"), ("1", "Tape", "b")]


STACK = "img_id string, z int, x int, y int, r int, g int, b int, a int"


def test_stack_in_order(spark):
    draw = random.Random(3)
    cells = [("p", z, x, 0, *(draw.randrange(256) for _ in range(3)), draw.choice([0, 1, 90, 254, 255])) for z in range(5) for x in range(30) if draw.random() < 0.6]
    found = {r.x: (r.r, r.g, r.b) for r in compose.stack(spark.createDataFrame(cells, STACK), 5).collect()}
    for x in {c[2] for c in cells}:
        out = [255, 255, 255]
        for *_, r, g, b, a in sorted(c for c in cells if c[2] == x):
            out = [(v * a + o * (255 - a) + 127) // 255 for v, o in zip((r, g, b), out)]
        assert found[x] == tuple(out)


def test_stack_opaque_is_stack_for_opaque_layers(spark, rows):
    draw = random.Random(4)
    cells = [(f"p{p}", z, x, 1, *(draw.randrange(256) for _ in range(3)), 255) for p in "ab" for z in range(3) for x in range(9) if draw.random() < 0.5]
    df = spark.createDataFrame(cells, STACK)
    assert rows(compose.stack(df, 3)) == rows(compose.stack_opaque(df))


def test_transparent_layers_leave_white(spark):
    df = spark.createDataFrame([("p", 0, 0, 0, 1, 2, 3, 0)], STACK)
    assert tuple(compose.stack(df, 1).first()) == ("p", 0, 0, 255, 255, 255)


def test_pictures_without_layers_and_shared_keys(spark, rows):
    sets = spark.createDataFrame(
        [("k_0", ["2", "1"], ["A", "B"]), ("k_0", ["1", "2"], ["A", "B"]), ("e_0", [], [])],
        "img_id string, sku_list array<string>, type_list array<string>",
    )
    one = compose.one_set_per_picture(sets)
    assert rows(compose.set_members(one)) == [("k_0", 0, "1", "A"), ("k_0", 1, "2", "B")]
    assert rows(compose.stack_opaque(compose.blank_pictures(one))) == [("e_0", 0, 0, 255, 255, 255), ("k_0", 0, 0, 255, 255, 255)]


@pytest.mark.parametrize("rows_per_task", [1_000_000, 2])
def test_gathered_layers(spark, rows, rows_per_task):
    members = spark.createDataFrame(
        [(f"p{i}", 0, "1", "A") for i in range(20)] + [("p1", 1, "2", "B"), ("p1", 2, "9", "C")], "img_id string, z int, oms_id string, product_type string"
    )
    pixels = spark.createDataFrame([("1", "A", x, 0, 1, 2, 3, 255) for x in range(3)] + [("2", "B", 0, 0, 4, 5, 6, 255)], "oms_id string, product_type string, x int, y int, r int, g int, b int, a int")
    plain = members.join(pixels, ["oms_id", "product_type"]).drop("oms_id", "product_type")
    assert rows(compose.gather_layers(members, pixels, rows_per_task)) == rows(plain)


@pytest.mark.parametrize("alpha", [True, False])
def test_resized_counts_missing_pixels_as_white(spark, alpha):
    draw = random.Random(6)
    side, sizes = 10, [3, 4, 10]
    full = np.full((side, side, 4), [255, 255, 255, 0])
    drawn = [(x, y) for x in range(side) for y in range(side) if draw.random() < 0.4]
    for x, y in drawn:
        full[y, x] = [draw.randrange(256) for _ in range(3)] + [255]
    data = [("i", x, y, *map(int, full[y, x])) for x, y in drawn]
    df = compose.resized(spark.createDataFrame(data, PIXEL), ["image_id"], side, sizes, alpha)
    channels = 4 if alpha else 3
    for r in df.collect():
        block = [full[y, x] for x in range(side) for y in range(side) if (x * r.size // side, y * r.size // side) == (r.x, r.y)]
        assert tuple(r)[4:] == tuple(int(c) for c in np.sum(block, 0) // len(block))[:channels]
    assert df.count() == sum(len({(x * n // side, y * n // side) for x, y in drawn}) for n in sizes)


def test_pictures_are_not_enlarged(spark):
    with pytest.raises(ValueError):
        compose.resized(spark.createDataFrame([], PIXEL), ["image_id"], 4, [5])
