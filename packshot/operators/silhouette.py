"""Telling a product from its white background."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packshot.operators.raster import LUMA_BLUE, LUMA_GREEN, LUMA_RED, LUMA_STEP, LUMA_WHITE, luma
from packshot.operators.blocks import pixels
from packshot.operators.regions import NO_LEVEL, TILE, Tiles, check_levels, merge_regions, paint, tile_pixels, tile_regions
from packshot.operators.skew import find_hot, salted_join
from packshot.runtime import materialise
from packshot.sources.images import read_images
from packshot.sources.layouts import ImageSettings


def cutoff_levels(settings: ImageSettings) -> int:
    """Number of the gray cutoff that reaches white; levels count from 0 in steps of 0.01."""
    return max(0, math.ceil((1.0 - settings.silo_gray_max_cutoff) / 0.01 - 1e-9))


def mask_tiles(raster: DataFrame, settings: ImageSettings, max_side: int | None = None, tile: int = TILE) -> Tiles:
    """Stored tiles with all masks of an image: mask ``k`` for gray cutoff level ``k``, the last for white."""
    top = cutoff_levels(settings)
    check_levels(top + 2)
    start = round(settings.silo_gray_max_cutoff * LUMA_WHITE)
    white = round(settings.silo_white_min_cutoff * LUMA_WHITE)
    level = F.greatest(F.lit(0), F.ceil((F.col("luma") - start) / F.lit(LUMA_STEP)).cast("int"))
    rgb = (F.col("r") * 65536 + F.col("g") * 256 + F.col("b")).alias("rgb")
    pixels = raster.select("image_id", "x", "y", rgb, luma().alias("luma"))
    pixels = pixels.select(
        "image_id", "x", "y", "rgb", F.when(level <= top, level).otherwise(NO_LEVEL).alias("level"),
        (F.col("luma") >= white).cast("int").alias("extra"),
    )
    return tile_pixels(pixels, top + 2, max_side, tile, store=True)


def image_tiles(images: DataFrame, settings: ImageSettings, tile: int = TILE) -> Tiles:
    """``mask_tiles`` of stored images ``(image_id, height, width, nChannels, data)``.

    The tiles are cut where the images are read: no pixel rows and no shuffle. A task holds one band
    of tiles of one image at a time.
    """
    top = cutoff_levels(settings)
    n_masks = top + 2
    check_levels(n_masks)
    start = round(settings.silo_gray_max_cutoff * LUMA_WHITE)
    white = round(settings.silo_white_min_cutoff * LUMA_WHITE)
    weights, step, none = (LUMA_BLUE, LUMA_GREEN, LUMA_RED), LUMA_STEP, NO_LEVEL

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        def band(pixels, n):
            """Masks and colour of a band of pixels, packed."""
            bgr = [pixels[..., min(c, n - 1)].astype(np.int64) for c in range(3)]
            gray = sum(w * c for w, c in zip(weights, bgr))
            level = np.maximum(-((start - gray) // step), 0)
            level[level > top] = none
            masks = (level << 8) + (gray >= white)
            return (masks << 24) + (bgr[2] << 16) + (bgr[1] << 8) + bgr[0]

        for batch in batches:
            ids = batch.column(0)
            h, w, n, data = (batch.column(i) for i in range(1, 5))
            for i in range(batch.num_rows):
                height, width, channels = h[i].as_py(), w[i].as_py(), n[i].as_py()
                pixels = np.frombuffer(data[i].as_buffer(), np.uint8)[: height * width * channels]
                pixels = pixels.reshape(height, width, channels)
                for top_row in range(0, height, tile):
                    packed = band(pixels[top_row : top_row + tile], channels)
                    place = np.arange(packed.shape[0])[:, None] * tile + np.arange(width)[None, :] % tile
                    packed += place << 40
                    cells = [packed[:, x : x + tile].ravel() for x in range(0, width, tile)]
                    offsets = np.cumsum([0, *map(len, cells)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(np.full(len(cells), i))),
                            pa.array(np.arange(len(cells), dtype=np.int32)),
                            pa.array(np.full(len(cells), top_row // tile, np.int32)),
                            pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(cells))),
                        ],
                        names=["image_id", "tx", "ty", "cells"],
                    )

    id_type = images.schema["image_id"].dataType.simpleString()
    source = images.select("image_id", "height", "width", "nChannels", "data")
    table = source.mapInArrow(cut, f"image_id {id_type}, tx int, ty int, cells array<bigint>")
    return Tiles(materialise(table), n_masks, tile, one_tile=False, extra=True)


def file_tiles(spark: SparkSession, path: str, settings: ImageSettings) -> Callable[[DataFrame], Tiles]:
    """What makes the tiles of the image files below ``path`` that a table ``(image_id)`` names.

    The operators that take tiles take this too: they say which images they use, and the others are not opened.
    """
    return lambda wanted: image_tiles(read_images(spark, path, wanted), settings)


def image_regions(tiles: Tiles) -> DataFrame:
    """The regions of all masks, stored: a small table that several steps read."""
    return materialise(merge_regions(tiles, tile_regions(tiles)))


def foreground_cutoff(regions: DataFrame, settings: ImageSettings) -> DataFrame:
    """Smallest gray cutoff whose non-white mask covers enough of the image once small regions are gone.

    ``regions`` comes from ``image_regions``. Result ``(image_id, n_pixels, level, cutoff,
    covered)``, ``cutoff`` on the luma scale.
    """
    return _cutoffs(_kept(regions, find_hot(regions, ["image_id"]), settings), settings)


def _kept(regions: DataFrame, hot: DataFrame | None, settings: ImageSettings) -> DataFrame:
    """Regions larger than the size cutoff, with the number of pixels of their image."""
    # the last gray level takes in every pixel of an image
    top = cutoff_levels(settings)
    whole = regions.where(F.lit(top).between(F.col("mask"), F.col("until")))
    totals = whole.groupBy("image_id").agg(F.sum("size").alias("n_pixels"))
    sized = salted_join(regions, totals, ["image_id"], hot, F.xxhash64("mask", "region"))
    return sized.where(F.col("total") > F.col("n_pixels") * F.lit(settings.silo_filter_size_cutoff))


def _cutoffs(kept: DataFrame, settings: ImageSettings) -> DataFrame:
    covered = (
        kept.where(F.col("mask") <= cutoff_levels(settings))
        .withColumn("mask", F.explode(F.sequence("mask", "until")))
        .groupBy("image_id", "n_pixels", "mask")
        .agg(F.sum("size").alias("covered"))
        .where(F.col("covered") > F.col("n_pixels") * F.lit(settings.silo_min_img_not_background))
    )
    start = round(settings.silo_gray_max_cutoff * LUMA_WHITE)
    return (
        covered.groupBy("image_id", "n_pixels")
        .agg(F.min("mask").alias("level"), F.min_by("covered", "mask").alias("covered"))
        .select("image_id", "n_pixels", "level", (F.col("level") * LUMA_STEP + start).alias("cutoff"), "covered")
    )


def _seed_values(regions: DataFrame, settings: ImageSettings) -> DataFrame:
    """``(image_id, mask, region, value)`` of the tile regions that are seeds: 1 white, 2 gray at the image's level."""
    white = cutoff_levels(settings) + 1
    hot = find_hot(regions, ["image_id"])
    kept = _kept(regions, hot, settings)
    levels = _cutoffs(kept, settings).select("image_id", "level")
    gray = F.col("level").between(F.col("mask"), F.col("until"))
    wanted = salted_join(kept, levels, ["image_id"], hot, F.xxhash64("mask", "region")).where(gray | (F.col("mask") == white))
    is_white = F.col("mask") == white
    return wanted.select(
        "image_id", F.when(is_white, white).otherwise(F.col("level")).alias("mask"), "region", F.when(is_white, 1).otherwise(2).alias("value")
    )


def seeds(tiles: Tiles, regions: DataFrame, settings: ImageSettings) -> DataFrame:
    """``(image_id, x, y, rgb, seed)``: 1 white, 2 foreground, 3 both. Other pixels give no row."""
    found = paint(tiles, _seed_values(regions, settings))
    rgb = F.expr("r * 65536 + g * 256 + b").alias("rgb")
    return pixels(found, ["image_id"], tile=tiles.tile).select("image_id", "x", "y", rgb, F.col("a").alias("seed"))


def foreground_blocks(tiles: Tiles, settings: ImageSettings) -> DataFrame:
    """The foreground (seeds of kind 2) as blocks: ``(image_id, tx, ty, min_x, max_x, min_y, max_y, cells)``."""
    return paint(tiles, _seed_values(image_regions(tiles), settings), only=2)


def foreground(tiles: Tiles, settings: ImageSettings) -> DataFrame:
    """``(image_id, x, y, r, g, b)`` of the foreground pixels."""
    return pixels(foreground_blocks(tiles, settings), ["image_id"], alpha=False, tile=tiles.tile)
