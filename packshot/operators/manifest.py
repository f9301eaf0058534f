"""Names of the pictures a run writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packshot.functions.paths import BUNDLE_FOLDER, LAYER_FOLDER, sized_name
from packshot.sources.layouts import ImageSettings


def _sizes(settings: ImageSettings) -> Column:
    return F.explode(F.array(*[F.lit(s) for s in settings.sizes]))


def image_manifest(layers: DataFrame, sets: DataFrame, settings: ImageSettings, folder: str, day: str) -> DataFrame:
    """``(kind, image, size, path)`` of every layer (PNG) and bundle picture at every size.

    ``layers`` is ``(oms_id, product_type)``: a SKU used as two types has two layers.
    """
    layer_names = layers.select(
        F.lit(LAYER_FOLDER).alias("kind"), F.concat_ws("_", "oms_id", "product_type").alias("image"), F.lit("png").alias("ext")
    )
    bundle_names = sets.select(
        F.lit(BUNDLE_FOLDER).alias("kind"), F.col("img_id").alias("image"), F.lit(settings.bundle_image_filetype).alias("ext")
    )
    names = layer_names.unionAll(bundle_names).withColumn("size", _sizes(settings))
    return names.select("kind", "image", "size", picture_path("kind", "image", "ext", settings, folder, day).alias("path"))


def picture_path(kind: Column | str, image: Column | str, ext: Column | str, settings: ImageSettings, folder: str, day: str) -> Column:
    """The name of a picture of a run, under which it is stored and listed.

    It ends with column ``size``, but not where the settings name no sizes.
    """
    name = F.concat_ws(".", image, ext)
    return F.concat_ws("/", F.lit(folder), F.lit(day), kind, sized_name(name, F.col("size")) if settings.image_sizes else name)
