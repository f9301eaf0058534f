"""Blocks against plain definitions on small pictures, in tiles that cut them."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from packshot.operators import blocks, compose, raster, regions
from packshot.operators.layers import BOX
from packshot.plans import jobs
from packshot.sources.layouts import ImageSettings

PIXEL = "image_id string, x int, y int, r int, g int, b int, a int"


def drawn(seed, w, h, share=0.6, alphas=(255,)):
    draw = random.Random(seed)
    return {
        (x, y): (*(draw.randrange(256) for _ in range(3)), draw.choice(alphas)) for x in range(w) for y in range(h) if draw.random() < share
    }


def frame(spark, pictures):
    return spark.createDataFrame([(k, *p, *c) for k, v in pictures.items() for p, c in v.items()], PIXEL)


def pictures_of(df, *keys):
    found = {}
    for r in df.collect():
        found.setdefault(tuple(r[k] for k in keys), {})[r.x, r.y] = tuple(r[c] for c in "rgba" if c in r)
    return found


def test_pack_and_unpack(spark):
    pictures = {"a": drawn(1, 13, 9), "b": drawn(2, 3, 3, alphas=(0, 7, 255)), "c": {(40, 17): (1, 2, 3, 0)}}
    packed = blocks.pack(frame(spark, pictures), ["image_id"], tile=4)
    assert pictures_of(blocks.pixels(packed, ["image_id"], tile=4), "image_id") == {(k,): v for k, v in pictures.items()}
    assert packed.where("image_id = 'a'").count() == len({(x // 4, y // 4) for x, y in pictures["a"]})


@pytest.mark.parametrize("alphas", [(255,), (0, 1, 90, 254, 255)])
@pytest.mark.parametrize("batch", [10_000, 3])
def test_stack_in_tiles(spark, alphas, batch):
    layers = {(p, z): drawn(z * 7 + p, 11, 10, 0.5, alphas) for p in range(6) for z in range(4)}
    rows = [(p, z, x, y, *c) for (p, z), v in layers.items() for (x, y), c in v.items()]
    df = spark.createDataFrame(rows, "key long, z int, x int, y int, r int, g int, b int, a int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        stacked = blocks.stack(blocks.pack(df, ["key", "z"], tile=4), "key", tile=4)
        found = pictures_of(blocks.pixels(stacked, ["key"], alpha=False, tile=4), "key")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for p in range(6):
        want = {}
        for z in range(4):
            for place, (*rgb, a) in layers[p, z].items():
                below = want.get(place, (255, 255, 255))
                want[place] = tuple((v * a + o * (255 - a) + 127) // 255 for v, o in zip(rgb, below))
        assert found[p,] == want


@pytest.mark.parametrize("alpha", [True, False])
@pytest.mark.parametrize("tile", [4, 128])
def test_shrink_in_tiles(spark, alpha, tile):
    side, sizes = 17, [2, 5, 16, 17]
    pictures = {"a": drawn(3, side, side, 0.4), "b": drawn(4, side, 6)}
    packed = blocks.pack(frame(spark, pictures), ["image_id"], tile)
    shrunk = blocks.shrink(packed, ["image_id"], side, sizes, alpha, tile)
    assert "Generate explode" not in shrunk._jdf.queryExecution().executedPlan().toString()
    found = pictures_of(blocks.pixels(shrunk, ["image_id", "size"], alpha, tile), "image_id", "size")
    for k, v in pictures.items():
        full = np.full((side, side, 4), [255, 255, 255, 0])
        for (x, y), c in v.items():
            full[y, x] = c
        for size in sizes:
            cells = {}
            for y in range(side):
                for x in range(side):
                    cells.setdefault((x * size // side, y * size // side), []).append((x, y))
            want = {
                at: tuple(int(n) for n in np.sum([full[y, x] for x, y in of], 0) // len(of))[: 4 if alpha else 3]
                for at, of in cells.items()
                if any(p in v for p in of)
            }
            assert found[k, size] == want


@pytest.mark.parametrize("channels", [3, 4])
def test_pictures_of_bytes(spark, channels):
    pictures = {"a": drawn(5, 9, 9, alphas=(0, 9, 255)), "b": {(8, 0): (1, 2, 3, 4)}}
    packed = blocks.pack(frame(spark, pictures), ["image_id"], 4).withColumn("size", F.lit(9))
    for r in blocks.assemble(packed, ["image_id"], channels, 4).collect():
        want = np.full((9, 9, 4), [255, 255, 255, 0], np.uint8)
        for (x, y), (red, green, blue, a) in pictures[r.image_id].items():
            want[y, x] = blue, green, red, a
        assert bytes(r.data) == want[..., :channels].tobytes()


def test_resampled_blocks(spark):
    source = drawn(6, 14, 11, 0.7)
    cut = blocks.pack(frame(spark, {"i": source}), ["image_id"], 4)
    sizes = [(3, 2, 30, 25), (20, 0, 7, 5), (0, 35, 1, 40), (-0, 0, 14, 11)]
    box = {"min_x": 2, "max_x": 12, "min_y": 1, "max_y": 10, "src_w": 11, "src_h": 10}
    placed = spark.createDataFrame(
        [(str(i), left, top, *box.values(), w, h) for i, (left, top, w, h) in enumerate(sizes)],
        "oms_id string, left int, top int, min_x int, max_x int, min_y int, max_y int, src_w int, src_h int, out_w long, out_h long",
    )
    rows = placed.crossJoin(cut.drop("image_id"))
    found = pictures_of(blocks.pixels(blocks.resample(rows, ["oms_id"], 40, 4), ["oms_id"], tile=4), "oms_id")
    for i, (left, top, w, h) in enumerate(sizes):
        want = {}
        for tx in range(w):
            for ty in range(h):
                c = source.get((2 + (2 * tx + 1) * 11 // (2 * w), 1 + (2 * ty + 1) * 10 // (2 * h)))
                if c and left + tx < 40 and top + ty < 40:
                    want[left + tx, top + ty] = c
        assert found.get((str(i),), {}) == want


def test_equal_sets_are_drawn_once(spark, monkeypatch):
    layer = blocks.pack(frame(spark, {"i": drawn(8, 5, 5)}).withColumnsRenamed({"image_id": "oms_id"}), ["oms_id"])
    layer = layer.withColumn("product_type", F.lit("Saw"))
    sets = spark.createDataFrame(
        [(f"p{i}", ["i"], ["Saw"]) for i in range(1000)] + [("other", ["i", "i"], ["Saw", "Tape"]), ("none", [], [])],
        "img_id string, sku_list array<string>, type_list array<string>",
    )
    drawn_sets, names = jobs.bundle_job(sets, layer)
    assert drawn_sets.count() == 3
    shown = pictures_of(blocks.pixels(compose.by_name(drawn_sets, names), ["img_id"]), "img_id")
    assert len(shown) == 1002 and shown["p0",] == shown["p999",] and shown["none",] == {(0, 0): (255, 255, 255, 255)}


def test_only_members_with_layers_are_stored(spark, monkeypatch):
    """Sets that show the same, for want of the other layers, are one; those that show nothing are another."""
    layer = spark.createDataFrame([("1", "Saw", 0, 0, [5 << 32 | 255])], "oms_id string, product_type string, tx int, ty int, cells array<bigint>")
    sets = spark.createDataFrame(
        [(f"p{i}", [f"x{i}", "1"], ["Saw", "Saw"]) for i in range(20)] + [(f"e{i}", [f"y{i}"], ["Saw"]) for i in range(20)] + [(None, ["1"], ["Saw"])],
        "img_id string, sku_list array<string>, type_list array<string>",
    )
    stored = []
    real = jobs.materialise
    monkeypatch.setattr(jobs, "materialise", lambda df: stored.append(real(df)) or stored[-1])
    drawn_sets, names = jobs.bundle_job(sets, layer)
    assert [s.count() for s in stored] == [21, 41, 2] and drawn_sets.count() == 3
    shown = pictures_of(blocks.pixels(compose.by_name(drawn_sets, names), ["img_id"]), "img_id")
    white = {(0, 0): (255, 255, 255, 255)}
    assert len(shown) == 41 and shown["p3",] == shown[None,] == white | {(5, 0): (0, 0, 0, 255)} and shown["e7",] == white
    drawn_sets, names = jobs.bundle_job(sets, layer, blank=False)
    shown = pictures_of(blocks.pixels(compose.by_name(drawn_sets, names), ["img_id"]), "img_id")
    assert len(shown) == 21 and shown["p3",] == {(5, 0): (0, 0, 0, 255)}


def test_kernels_take_bounded_slices(spark):
    """A kernel holds many arrays as long as its slice, and an executor runs several kernels."""
    assert blocks.SLICE <= 1 << 18 and regions.ROUND <= 1 << 17
    sizes = np.full(10_000, 400)
    slices = list(blocks.group_slices(np.arange(10_000), sizes))
    assert max(int(sizes[a:b].sum()) for a, b in slices) <= 1 << 18 and slices[-1][1] == 10_000


def test_boxes_of_blocks_are_boxes_of_pixels(spark, rows):
    pictures = {"a": drawn(9, 30, 20, 0.1), "b": drawn(10, 4, 33, 0.2)}
    df = frame(spark, pictures)
    packed = blocks.pack(df, ["image_id"], 8)
    spots = [("x", "tx * 8 + shiftright(c, 32) % 8"), ("y", "ty * 8 + shiftright(c, 32) div 8")]
    boxed = packed.select("*", *[F.expr(f"array_{f}(transform(cells, c -> {e}))").alias(f"{f}_{c}") for c, e in spots for f in ("min", "max")])
    assert set(BOX) <= set(boxed.columns)
    settings = ImageSettings((8,), "png", 2, 0)
    assert rows(raster.bounding_box_of_blocks(boxed, settings)) == rows(raster.bounding_box(df, settings))


def test_no_shuffle_of_pixel_rows(spark):
    sets = spark.createDataFrame([("p", ["1"], ["Saw"])], "img_id string, sku_list array<string>, type_list array<string>")
    layer = spark.createDataFrame([("1", "Saw", 0, 0, [5 << 32 | 255])], "oms_id string, product_type string, tx int, ty int, cells array<bigint>")
    drawn_sets, names = jobs.bundle_job(sets, layer)
    plan = blocks.pixels(compose.by_name(blocks.shrink(drawn_sets, ["set_key"], 20, [5, 20]), names), ["img_id", "size"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    # the only explode is the last step, above every exchange
    assert text.count("Generate explode(cells") == 1 and text.index("Generate explode(cells") < text.index("Exchange")
