"""Whole jobs: from bundle lines, attributes and source images to pictures. Nothing is collected."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packshot.functions.paths import BUNDLE_FOLDER, LAYER_FOLDER
from packshot.operators.attributes import sku_images, skus_missing
from packshot.operators import blocks
from packshot.operators.compose import NOTHING, by_name, draw_sets, one_set_per_picture, set_dictionary, shared_names, shown_layers
from packshot.operators.layers import build_layers, one_image_per_layer
from packshot.operators.layout import layout_types, sku_layers
from packshot.operators.manifest import image_manifest, picture_path
from packshot.operators.product_sets import product_sets
from packshot.operators.products import first_per_type_lines, layer_skus, sku_counts
from packshot.operators.regions import Tiles
from packshot.runtime import materialise
from packshot.sources.bundles import write_image_id_mapping
from packshot.sources.images import picture_structs, write_images
from packshot.sources.layouts import ImageSettings


LAYER_KEYS = ["oms_id", "product_type"]


def layer_job(
    skus: DataFrame,
    attributes: DataFrame,
    tiles: Tiles | Callable[[DataFrame], Tiles],
    layers: DataFrame,
    settings: ImageSettings,
    image_id: Column,
) -> DataFrame:
    """Layer blocks of every SKU of a bundle that has an image and a place in the layout.

    ``tiles`` come from image files (``file_tiles``, which opens the files that are used), from stored images
    (``image_tiles``) or from a raster table (``mask_tiles``);
    ``image_id`` turns ``img_guid`` of the attributes into their id.
    """
    images = sku_images(attributes, skus).select("oms_id", "product_type", image_id.alias("image_id"))
    placed = sku_layers(one_image_per_layer(images), layers)
    return build_layers(tiles, placed, settings)


def bundle_job(sets: DataFrame, layer_blocks: DataFrame, blank: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(blocks, names)``: the pictures of the distinct product sets by ``set_key``, and which ``img_id`` shows which.

    From sets with types and stored layer blocks. Sets of equal content are drawn once, and those without any layer
    share one picture. What sets with layers show is stored, and so are the names: planning the join, the join itself and blank pictures
    read them. ``blank`` puts a white pixel below every picture, so that those without layers show up; without it these have no name.
    """
    sets = sets.select("img_id", "sku_list", "type_list")
    if shared_names(sets):
        sets = materialise(one_set_per_picture(sets))
    shown = materialise(shown_layers(sets, layer_blocks))
    names = shown.select("img_id", "set_key")
    if blank:
        keys = shown.select(F.col("img_id").alias("_shown"), "set_key")
        key = F.coalesce("set_key", F.unhex(F.lit(NOTHING))).alias("set_key")
        names = materialise(sets.select("img_id").join(keys, F.col("img_id").eqNullSafe(F.col("_shown")), "left").select("img_id", key))
    return draw_sets(materialise(set_dictionary(shown)), layer_blocks, blank), names


@dataclass
class Pictures:
    """Results of ``picture_job``; sets, names and layers are stored, the rest is lazy."""

    sets: DataFrame
    layers: DataFrame
    layer_blocks: DataFrame
    set_blocks: DataFrame
    names: DataFrame

    @property
    def layer_pixels(self) -> DataFrame:
        return blocks.pixels(self.layer_blocks, LAYER_KEYS)

    @property
    def bundle_pixels(self) -> DataFrame:
        return blocks.pixels(by_name(self.set_blocks, self.names), ["img_id"], alpha=False)


def picture_job(
    lines: DataFrame,
    attributes: DataFrame,
    tiles: Tiles | Callable[[DataFrame], Tiles],
    layers: DataFrame,
    settings: ImageSettings,
    image_id: Column,
    all_sets: bool = False,
) -> Pictures:
    """Bundles to pictures. SKUs are listed before the lists are cut to one product per type.

    ``all_sets`` keeps every product and so draws every product set. The layers are stored once,
    since both the layer files and the bundle pictures read them.
    """
    lines = materialise(lines)
    skus = layer_skus(lines)
    if not all_sets:
        lines = first_per_type_lines(lines)
    sets = materialise(product_sets(lines, layout_types(layers), with_types=True))
    drawn = materialise(layer_job(skus, attributes, tiles, layers, settings, image_id))
    return Pictures(sets, skus, drawn, *bundle_job(sets, drawn))


def write_pictures(pictures: Pictures, settings: ImageSettings, folder: str, day: str) -> None:
    """Store layers, bundle pictures and the id mapping of a run, as image structs.

    Every size of ``image_sizes``, or the canvas as it is where there are none. A set that several pictures show is
    shrunk and put together once.
    """
    sizes, side = list(settings.sizes), settings.canvas
    shrunk = blocks.shrink(pictures.layer_blocks, LAYER_KEYS, side, sizes, alpha=True)
    layers = picture_structs(shrunk, LAYER_KEYS, alpha=True)
    name = picture_path(F.lit(LAYER_FOLDER), F.concat_ws("_", *LAYER_KEYS), F.lit("png"), settings, folder, day)
    layers = layers.withColumn("path", name).withColumnsRenamed({"oms_id": "image_id"})
    write_images(layers, f"{folder}/{LAYER_FOLDER}", day, LAYER_FOLDER)
    shrunk = blocks.shrink(pictures.set_blocks, ["set_key"], side, sizes, together=True)
    bundles = by_name(picture_structs(shrunk, ["set_key"], alpha=False), pictures.names)
    name = picture_path(F.lit(BUNDLE_FOLDER), F.col("img_id"), F.lit(settings.bundle_image_filetype), settings, folder, day)
    bundles = bundles.withColumn("path", name).withColumnsRenamed({"img_id": "image_id"})
    write_images(bundles, f"{folder}/{BUNDLE_FOLDER}", day, BUNDLE_FOLDER)
    write_image_id_mapping(pictures.sets, folder, day)


def picture_manifest(pictures: Pictures, settings: ImageSettings, folder: str, day: str) -> DataFrame:
    """Names of the pictures of a run, as in column ``path`` of what ``write_pictures`` stores: drawn layers and all sets."""
    drawn = pictures.layer_blocks.select(*LAYER_KEYS).distinct()
    return image_manifest(drawn, pictures.sets.select("img_id").distinct(), settings, folder, day)


def audit(skus: DataFrame, attributes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SKUs of a list without attributes, and how often each SKU is listed."""
    return skus_missing(skus, attributes), sku_counts(skus)
