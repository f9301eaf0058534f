"""Layers: the cut-out product of an image, scaled and placed on the canvas."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packshot.operators import blocks
from packshot.operators.layout import first_layer
from packshot.operators.raster import bounding_box_of_blocks, placement
from packshot.operators.regions import Tiles
from packshot.operators.silhouette import foreground_blocks
from packshot.operators.skew import find_hot, plan_by_output, salted_join
from packshot.runtime import broadcast_if_small, materialise
from packshot.sources.layouts import ImageSettings


BOX = ("min_x", "max_x", "min_y", "max_y")
_AXES = (("x", f"tx * {blocks.TILE} + shiftright(c, 32) % {blocks.TILE}"), ("y", f"ty * {blocks.TILE} + shiftright(c, 32) div {blocks.TILE}"))
_ENDS = (("array_min", "min"), ("array_max", "max"))


def one_image_per_layer(sku_images: DataFrame) -> DataFrame:
    """One image per (SKU, type), as a layer shows one: the first id of a SKU that has several."""
    return sku_images.groupBy("oms_id", "product_type").agg(F.min("image_id").alias("image_id"))


def layer_placements(
    placed_skus: DataFrame, boxes: DataFrame, settings: ImageSettings, hot: DataFrame | None = None
) -> DataFrame:
    """Placement of every (SKU, type): ``placed_skus`` with ``image_id, ulx, uly, w`` and the image boxes.

    ``hot`` names images that very many SKUs share (a stand-in picture, say); see ``find_hot``.
    """
    joined = salted_join(placed_skus, boxes, ["image_id"], hot, F.xxhash64("oms_id", "product_type"))
    return placement(joined, settings)


def layer_blocks(placements: DataFrame, cutouts: DataFrame, settings: ImageSettings, blocks_per_task: int = 1_000) -> DataFrame:
    """Blocks of each layer on the canvas: ``(oms_id, product_type, tx, ty, cells)``, opaque cells only.

    The box (both edges included) is scaled to the rounded size and every target pixel takes the
    nearest source pixel. ``cutouts`` are blocks by ``image_id``, with the box of each (``foreground_blocks``). Many
    SKUs may share an image, and each brings all its blocks: the join is cut by the rows it gives, so both
    inputs should be stored.
    """
    sized = placements.where(F.col("scale").isNotNull()).select(
        "oms_id", "product_type", "image_id", "left", "top", "min_x", "max_x", "min_y", "max_y",
        (F.col("max_x") - F.col("min_x") + 1).alias("src_w"),
        (F.col("max_y") - F.col("min_y") + 1).alias("src_h"),
        F.rint((F.col("max_x") - F.col("min_x") + 1) * F.col("scale")).cast("bigint").alias("out_w"),
        F.rint((F.col("max_y") - F.col("min_y") + 1) * F.col("scale")).cast("bigint").alias("out_h"),
    ).where((F.col("src_w") > 0) & (F.col("src_h") > 0) & (F.col("out_w") > 0) & (F.col("out_h") > 0))
    source = cutouts.select("image_id", "tx", "ty", *[F.col(c).alias(f"_{c}") for c in BOX], "cells")
    meets = [(F.col(f"_min_{c}") <= F.col(f"max_{c}")) & (F.col(f"_max_{c}") >= F.col(f"min_{c}")) for c in "xy"]
    hot, tasks = plan_by_output(placements, source, ["image_id"], blocks_per_task)
    salt = F.xxhash64("oms_id", "product_type")
    joined = salted_join(sized, source, ["image_id"], hot, salt, tasks=tasks).where(meets[0] & meets[1])
    return blocks.resample(joined, ["oms_id", "product_type"], settings.canvas)


def layer_raster(
    placements: DataFrame, cutouts: DataFrame, settings: ImageSettings, blocks_per_task: int = 1_000
) -> DataFrame:
    """``layer_blocks`` from and to pixel rows: ``(oms_id, product_type, x, y, r, g, b, a)``."""
    packed = blocks.pack(cutouts.withColumn("a", F.lit(255)), ["image_id"])
    place = [F.expr(f"{f}(transform(cells, c -> cast({at} as int)))").alias(f"{n}_{c}") for c, at in _AXES for f, n in _ENDS]
    boxed = packed.select("*", *place)
    return blocks.pixels(layer_blocks(placements, boxed, settings, blocks_per_task), ["oms_id", "product_type"])


def tiles_of(tiles: Tiles | Callable[[DataFrame], Tiles], placed_skus: DataFrame) -> Tiles:
    """The tiles of the images that ``placed_skus`` use; images that come as files are opened only if they are used."""
    used = placed_skus.select("image_id").distinct()
    if callable(tiles):
        return tiles(used)
    return replace(tiles, table=tiles.table.join(used, "image_id", "left_semi"))


def layers_missing(
    skus: DataFrame, images: DataFrame, image_ids: DataFrame, boxes: DataFrame, layers: DataFrame, settings: ImageSettings
) -> DataFrame:
    """``(oms_id, product_type, reason)`` of the layers that are not drawn.

    ``skus``: the layers asked for; ``images``: ``(oms_id, product_type, image_id)`` by the attributes;
    ``image_ids``: the images there are; ``boxes``: their bounding boxes; ``layers``: the layout. The first reason counts: no
    place in the layout, no image by the attributes, no file, no foreground, no extent.
    """
    keys = ["oms_id", "product_type"]
    named = one_image_per_layer(images).select(F.col("oms_id").alias("_oms"), F.col("product_type").alias("_type"), "image_id")
    asked = skus.select(*keys).distinct()
    asked = asked.join(named, F.col("oms_id").eqNullSafe(F.col("_oms")) & F.col("product_type").eqNullSafe(F.col("_type")), "left")
    places = broadcast_if_small(first_layer(layers).select("product_type", "ulx", "uly", "w"))
    there = image_ids.select("image_id", F.lit(True).alias("_file")).distinct()
    found = placement(asked.join(places, "product_type", "left").join(there, "image_id", "left").join(boxes, "image_id", "left"), settings)
    drawn = [F.rint((F.col(f"max_{c}") - F.col(f"min_{c}") + 1) * F.col("scale")) > 0 for c in "xy"]
    solid = [F.col(f"max_{c}") >= F.col(f"min_{c}") for c in "xy"]
    extent = F.coalesce(drawn[0] & drawn[1] & solid[0] & solid[1], F.lit(False))
    reason = (
        F.when(F.col("ulx").isNull(), "no place")
        .when(F.col("image_id").isNull(), "no image")
        .when(F.col("_file").isNull(), "no file")
        .when(F.col("min_x").isNull(), "no foreground")
        .when(~extent, "no extent")
    )
    return found.select(*keys, reason.alias("reason")).where("reason is not null")


def build_layers(tiles: Tiles | Callable[[DataFrame], Tiles], placed_skus: DataFrame, settings: ImageSettings) -> DataFrame:
    """From the tiles of source images and placed SKUs to blocks of layers: silhouette, box, placement, scaling.

    Only images of placed SKUs are labelled. Cut-outs and placements are stored: several steps start from them.
    """
    placed_skus = materialise(placed_skus)
    tiles = tiles_of(tiles, placed_skus)
    if tiles.tile != blocks.TILE:
        raise ValueError(f"layers are made from tiles of {blocks.TILE}")
    cutouts = materialise(foreground_blocks(tiles, settings))
    hot = find_hot(placed_skus, ["image_id"])
    placements = materialise(layer_placements(placed_skus, bounding_box_of_blocks(cutouts, settings), settings, hot))
    return layer_blocks(placements, cutouts, settings)
