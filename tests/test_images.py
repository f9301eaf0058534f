"""Image files in, image structs out."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from packshot.functions.paths import image_file
from packshot.operators.silhouette import file_tiles, image_tiles, mask_tiles
from packshot.operators import compose, silhouette
from packshot.operators.attributes import PRIMARY_IMAGE
from packshot.plans import jobs
from packshot.sources import images
from packshot.sources.layouts import ImageSettings, read_image_settings


def png(path, pixels):
    """A PNG file from H x W x 3 or 4 values."""
    h, w, n = pixels.shape
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", w, h, 8, {3: 2, 4: 6}[n], 0, 0, 0)
    lines = b"".join(b"\0" + row.astype(np.uint8).tobytes() for row in pixels)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b""))


def test_image_files_to_raster(spark, rows, tmp_path):
    three = np.arange(18).reshape(2, 3, 3)
    four = np.arange(100, 108).reshape(1, 2, 4)
    png(tmp_path / "three.png", three)
    png(tmp_path / "four.png", four)
    (tmp_path / "broken.png").write_text("not an image")
    found = rows(images.to_raster(images.read_images(spark, str(tmp_path))))
    want = [("three.png", x, y, *map(int, three[y, x]), 255) for x in range(3) for y in range(2)]
    want += [("four.png", x, 0, *map(int, four[0, x])) for x in range(2)]
    assert sorted(found) == sorted(want)


def test_tiles_of_files_and_of_pixels_agree(spark, tmp_path):
    draw = np.random.default_rng(1)
    shades = np.array([0, 200, 243, 246, 249, 253, 255])
    png(tmp_path / "a.png", draw.choice(shades, (23, 37, 3)))
    png(tmp_path / "b.png", draw.choice(shades, (8, 16, 4)))
    png(tmp_path / "c.png", np.repeat(draw.choice(shades, (9, 9, 1)), 3, 2))
    files = images.read_images(spark, str(tmp_path))
    for settings in (ImageSettings((9,), "png", 1, 1), ImageSettings((9,), "png", 1, 1, silo_gray_max_cutoff=0.9, silo_white_min_cutoff=0.98)):
        ours, theirs = image_tiles(files, settings, 8), mask_tiles(images.to_raster(files), settings, tile=8)
        assert (ours.n_masks, ours.tile, ours.one_tile) == (theirs.n_masks, theirs.tile, theirs.one_tile)
        cells = lambda t: sorted((r.image_id, r.tx, r.ty, sorted(r.cells)) for r in t.table.collect())
        assert cells(ours) == cells(theirs)


def test_structs_fill_the_gaps(spark, rows):
    data = [("a", 0, 0, 1, 2, 3, 4), ("a", 2, 1, 5, 6, 7, 8), ("b", 3, 3, 9, 10, 11, 12)]
    df = spark.createDataFrame(data, images.RASTER_SCHEMA).withColumn("size", F.lit(4))
    for alpha, blank in ((True, (255, 255, 255, 0)), (False, (255, 255, 255, 255))):
        packed = images.to_image_structs(df, ["image_id"], "size", alpha)
        assert {len(r.data) for r in packed.collect()} == {64 if alpha else 48}
        found = {t[:3]: t[3:] for t in rows(images.to_raster(packed))}
        want = {(k, x, y): blank for k in "ab" for x in range(4) for y in range(4)}
        want |= {t[:3]: t[3:] if alpha else (*t[3:6], 255) for t in data}
        assert found == want


def test_stored_pictures(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 0, 0, 1, 2, 3, 255)], images.RASTER_SCHEMA).withColumn("size", F.lit(2))
    images.write_images(images.to_image_structs(df, ["image_id"], "size", False), str(tmp_path), "2020-10-20", "layer_imgs")
    assert (tmp_path / "day=2020-10-20" / "kind=layer_imgs" / "size=2").is_dir()
    assert len(rows(images.to_raster(spark.read.parquet(str(tmp_path)).drop("day")))) == 4


def test_from_files_to_pictures(spark, rows, tmp_path):
    """Two products, one of them used as two types and one without image."""
    square = np.full((20, 20, 3), 255)
    square[4:16, 4:16] = [200, 10, 10]
    bar = np.full((20, 30, 3), 255)
    bar[8:14, 2:28] = [10, 10, 200]
    (tmp_path / "img").mkdir()
    png(tmp_path / "img" / "square.png", square)
    png(tmp_path / "img" / "bar.png", bar)
    attribute = "645296e8-a910-43c3-803c-b51d3f1d4a89"
    attributes = spark.createDataFrame(
        [("1", attribute, "x/square.png"), ("2", attribute, "x/bar.png"), ("2", "colour", "blue")],
        "oms_id string, attribute_id string, attribute_value string",
    )
    product = lambda i, t: f'{{"id": "{i}", "productType": "{t}"}}'
    lines = spark.createDataFrame(
        [
            ("one", f"[{product(1, 'Saw')}, {product(2, 'Tape')}, {product(2, 'Saw')}]"),
            ("two", f"[{product(3, 'Saw')}]"),
            ("three", "[]"),
        ],
        "line_key string, product_list_json string",
    )
    layers = spark.createDataFrame(
        [("t", 0, "Saw", 0.1, 0.1, 0.5), ("t", 1, "Tape", 0.3, 0.3, 0.6)],
        "bundle_type string, pos int, product_type string, ulx double, uly double, w double",
    )
    settings = ImageSettings((5, 10, 20), "jpg", erode_size=1, bottom_border=2)
    tiles = image_tiles(images.read_images(spark, str(tmp_path / "img")), settings)

    def run(all_sets):
        return jobs.picture_job(lines, attributes, tiles, layers, settings, image_file("img_guid"), all_sets=all_sets)

    pictures = run(all_sets=False)
    assert rows(pictures.sets, "img_id") == [("one_0",), ("three_0",), ("two_0",)]
    assert rows(run(all_sets=True).sets, "img_id") == [("one_0",), ("one_1",), ("three_0",), ("two_0",)]
    drawn = {(r.img_id, r.x, r.y): (r.r, r.g, r.b) for r in pictures.bundle_pixels.collect()}
    # 9 of 10 pixels of the red box at scale 10 / 9, from (2, 2)
    red = {(x, y) for x in range(2, 13) for y in range(2, 13)}
    blue = {p for p, c in ((k[1:], c) for k, c in drawn.items() if k[0] == "one_0") if c == (10, 10, 200)}
    assert {(x, y) for k, x, y in drawn if k == "one_0"} - {(0, 0)} == red | blue
    assert min(blue) == (6, 6) and max(x for x, _ in blue) == 18
    assert all(drawn["one_0", x, y] == (200, 10, 10) for x, y in red - blue)
    assert {k for k in drawn if k[0] in ("two_0", "three_0")} == {("two_0", 0, 0), ("three_0", 0, 0)}

    out = str(tmp_path / "out")
    jobs.write_pictures(pictures, settings, out, "2020-10-20")
    stored = spark.read.parquet(f"{out}/package_imgs").where("size = 20")
    full = {(k, x, y): c[:3] for k, x, y, *c in (tuple(r) for r in images.to_raster(stored).collect())}
    full = {k: tuple(c) for k, c in full.items()}
    assert len(full) == 3 * 400
    assert {k: c for k, c in full.items() if c != (255, 255, 255)} == {k: c for k, c in drawn.items() if c != (255, 255, 255)}
    layer_files = spark.read.parquet(f"{out}/layer_imgs")
    assert rows(layer_files.select("image_id", "product_type").distinct()) == [("1", "Saw"), ("2", "Saw"), ("2", "Tape")]
    assert rows(layer_files.select("size").distinct()) == [(10,), (20,), (5,)]
    manifest = jobs.picture_manifest(pictures, settings, out, "2020-10-20")
    names = {r.path for r in manifest.collect()}
    assert f"{out}/2020-10-20/layer_imgs/2_Tape_10.png" in names and f"{out}/2020-10-20/package_imgs/one_0_5.jpg" in names
    assert len(names) == (3 + 3) * 3
    assert names == {r.path for kind in ("layer_imgs", "package_imgs") for r in spark.read.parquet(f"{out}/{kind}").collect()}
    assert rows(spark.read.csv(f"{out}/2020-10-20/package_to_image_mapping.csv")) == [("one", "one_0"), ("three", "three_0"), ("two", "two_0")]


def test_only_wanted_files_are_opened(spark, tmp_path):
    for name in ("a.png", "b[1].png", "c.png", "d{x}.png", "e +%.png"):
        png(tmp_path / name, np.full((4, 5, 3), 7))
    wanted = spark.createDataFrame([("b[1].png",), ("d{x}.png",), ("d{x}.png",), ("gone.png",), (None,)], "image_id string")
    found = images.read_images(spark, str(tmp_path), wanted)
    assert len(found.inputFiles()) == 2  # of five
    assert sorted(r.image_id for r in found.collect()) == ["b[1].png", "d{x}.png"]
    assert {r.image_id for r in images.read_images(spark, str(tmp_path)).collect()} == {r.image_id for r in images.list_images(spark, str(tmp_path)).collect()}
    assert images.read_images(spark, str(tmp_path), wanted.where("image_id = 'gone.png'")).count() == 0
    plan = images.list_images(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    tiles = file_tiles(spark, str(tmp_path), ImageSettings((9,), "png", 1, 1))(wanted)
    assert {r.image_id for r in tiles.table.collect()} == {"b[1].png", "d{x}.png"}


def test_layers_open_the_files_they_use(spark, tmp_path, monkeypatch):
    square = np.full((20, 20, 3), 255)
    square[4:16, 4:16] = [200, 10, 10]
    (tmp_path / "img").mkdir()
    for i in range(6):
        png(tmp_path / "img" / f"{i}.png", square)
    opened = []
    real = images.read_images
    monkeypatch.setattr(silhouette, "read_images", lambda *a: opened.append(real(*a)) or opened[-1])
    attributes = spark.createDataFrame([(str(i), PRIMARY_IMAGE, f"x/{i}.png") for i in range(6)], "oms_id string, attribute_id string, attribute_value string")
    layers = spark.createDataFrame([("t", 0, "Saw", 0.1, 0.1, 0.5)], "bundle_type string, pos int, product_type string, ulx double, uly double, w double")
    skus = spark.createDataFrame([("2", "Saw"), ("4", "Saw"), ("5", "Lamp")], "oms_id string, product_type string")
    settings = ImageSettings((5, 20), "jpg", 1, 2)
    made = jobs.layer_job(skus, attributes, file_tiles(spark, str(tmp_path / "img"), settings), layers, settings, image_file("img_guid"))
    assert {r.oms_id for r in made.collect()} == {"2", "4"}
    assert sorted(f.rpartition("/")[2] for df in opened for f in df.inputFiles()) == ["2.png", "4.png"]  # the lamp has no place


def test_unscaled_pictures(spark, rows, tmp_path):
    """Without sizes every picture is stored once, as drawn, on a canvas of more than one tile."""
    path = tmp_path / "settings.json"
    path.write_text('{"bundle_image_filetype": "jpg", "erode_size": 0, "bottom_border": 0, "canvas_side": 200}')
    settings = read_image_settings(spark, str(path))
    assert settings.image_sizes is None and settings.canvas == 200 and settings.sizes == (200,)
    square = np.full((150, 150, 3), 255)
    square[10:140, 10:140] = np.arange(130 * 130 * 3).reshape(130, 130, 3) % 200
    (tmp_path / "img").mkdir()
    png(tmp_path / "img" / "square.png", square)
    attributes = spark.createDataFrame([("1", PRIMARY_IMAGE, "x/square.png")], "oms_id string, attribute_id string, attribute_value string")
    lines = spark.createDataFrame([("one", '[{"id": "1", "productType": "Saw"}]')], "line_key string, product_list_json string")
    layers = spark.createDataFrame([("t", 0, "Saw", 0.0, 0.0, 0.9)], "bundle_type string, pos int, product_type string, ulx double, uly double, w double")
    tiles = file_tiles(spark, str(tmp_path / "img"), settings)
    pictures = jobs.picture_job(lines, attributes, tiles, layers, settings, image_file("img_guid"))
    out = str(tmp_path / "out")
    jobs.write_pictures(pictures, settings, out, "2020-10-20")
    stored = spark.read.parquet(f"{out}/package_imgs").collect()
    assert [r.path for r in stored] == [f"{out}/2020-10-20/package_imgs/one_0.jpg"]
    assert {r.path for r in jobs.picture_manifest(pictures, settings, out, "2020-10-20").collect()} == {
        f"{out}/2020-10-20/package_imgs/one_0.jpg", f"{out}/2020-10-20/layer_imgs/1_Saw.png"
    }
    got = np.frombuffer(stored[0].data, np.uint8).reshape(200, 200, 3)
    width = round(130 * (180 / 129))
    at = (2 * np.arange(width) + 1) * 130 // (2 * width)
    want = np.full((200, 200, 3), 255)
    want[:width, :width] = square[10:140, 10:140][at][:, at][..., ::-1]
    assert (got == want).all()


def test_the_usual_canvas(spark, rows, tmp_path):
    """Pictures of side 1000 at the six usual sizes: 64 tiles each."""
    side, sizes = 1000, (65, 100, 300, 400, 600, 1000)
    draw = np.random.default_rng(4)
    picture = np.full((500, 400, 3), 255)
    picture[30:470, 20:380] = np.kron(draw.integers(0, 230, (44, 36, 3)), np.ones((10, 10, 1), int))
    (tmp_path / "img").mkdir()
    png(tmp_path / "img" / "p.png", picture)
    settings = ImageSettings(sizes, "jpg", 0, 80)
    attributes = spark.createDataFrame([("1", PRIMARY_IMAGE, "x/p.png")], "oms_id string, attribute_id string, attribute_value string")
    lines = spark.createDataFrame([("one", '[{"id": "1", "productType": "Saw"}]')], "line_key string, product_list_json string")
    layers = spark.createDataFrame([("t", 0, "Saw", 0.1, 0.05, 0.6)], "bundle_type string, pos int, product_type string, ulx double, uly double, w double")
    tiles = file_tiles(spark, str(tmp_path / "img"), settings)
    pictures = jobs.picture_job(lines, attributes, tiles, layers, settings, image_file("img_guid"))
    out = str(tmp_path / "out")
    jobs.write_pictures(pictures, settings, out, "2020-10-20")
    stored = {r.size: np.frombuffer(r.data, np.uint8).reshape(r.size, r.size, 3) for r in spark.read.parquet(f"{out}/package_imgs").collect()}
    assert sorted(stored) == list(sizes)
    scale = 600 / 359
    if 439 * scale + 50 > side - 80:
        scale = (side - 80 - 50) / 439
    w, h = round(360 * scale), round(440 * scale)
    x, y = (2 * np.arange(w) + 1) * 360 // (2 * w), (2 * np.arange(h) + 1) * 440 // (2 * h)
    full = np.full((side, side, 3), 255)
    full[50 : 50 + h, 100 : 100 + w] = picture[30:470, 20:380][y][:, x][..., ::-1]
    for size in sizes:
        cell = np.arange(side) * size // side
        sums = np.zeros((size, size, 3), np.int64)
        np.add.at(sums, (cell[:, None], cell[None, :]), full)
        n = np.bincount(cell)
        assert (stored[size] == sums // (n[:, None, None] * n[None, :, None])).all()


def test_one_colour_per_place(spark):
    raster = spark.createDataFrame(
        [("i", 0, 0, 1, 2, 3, 255, 2), ("i", 0, 0, 9, 9, 9, 255, 2), ("i", 1, 1, 4, 5, 6, 255, 2)],
        "image_id string, x int, y int, r int, g int, b int, a int, size int",
    )
    data = images.to_image_structs(raster, ["image_id"], "size", alpha=False).first().data
    assert bytes(data) == bytes([3, 2, 1, 255, 255, 255, 255, 255, 255, 6, 5, 4])


def test_file_names_have_to_differ(spark, tmp_path):
    for folder in ("aa", "bb"):
        (tmp_path / folder).mkdir()
        png(tmp_path / folder / "x.png", np.zeros((2, 2, 3)))
    with pytest.raises(ValueError, match="one file name: x.png"):
        images.read_images(spark, f"{tmp_path}/*/*")


def test_a_layer_beyond_the_layout_raises(spark):
    pixels = spark.createDataFrame([("p", 3, 0, 0, 1, 1, 1, 255)], "img_id string, z int, x int, y int, r int, g int, b int, a int")
    with pytest.raises(Exception, match="beyond the 3 of the layout"):
        compose.stack(pixels, 3).collect()
