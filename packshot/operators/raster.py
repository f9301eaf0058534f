"""Gray values, masks and geometry of raster tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packshot.sources.layouts import ImageSettings

# Luma weights in ten-thousandths; pure white is 255 * (sum of the weights).
LUMA_RED, LUMA_GREEN, LUMA_BLUE = 2125, 7154, 721
LUMA_WHITE = 2_550_000
#: one step of the gray cutoff (0.01) on the luma scale
LUMA_STEP = 25_500


def luma() -> Column:
    """Gray value as an exact integer, 0 to 2,550,000."""
    return (LUMA_RED * F.col("r") + LUMA_GREEN * F.col("g") + LUMA_BLUE * F.col("b")).cast("int")


def gray(raster: DataFrame, settings: ImageSettings) -> DataFrame:
    """``(image_id, x, y, luma, is_white, is_non_white)`` with the first gray cutoff."""
    white = round(settings.silo_white_min_cutoff * LUMA_WHITE)
    non_white = round(settings.silo_gray_max_cutoff * LUMA_WHITE)
    return raster.select("image_id", "x", "y", luma().alias("luma")).select(
        "*", (F.col("luma") >= white).alias("is_white"), (F.col("luma") <= non_white).alias("is_non_white")
    )


def bounding_box(foreground: DataFrame, settings: ImageSettings) -> DataFrame:
    """Box around the foreground of each image, moved inwards by the erode size (may turn inside out)."""
    erode = settings.erode_size
    return foreground.groupBy("image_id").agg(
        (F.min("x") + erode).alias("min_x"),
        (F.max("x") - erode).alias("max_x"),
        (F.min("y") + erode).alias("min_y"),
        (F.max("y") - erode).alias("max_y"),
    )


def bounding_box_of_blocks(blocks: DataFrame, settings: ImageSettings) -> DataFrame:
    """``bounding_box`` from blocks with their own boxes (``foreground_blocks``): a row per tile and no pixel is read."""
    erode = settings.erode_size
    return blocks.groupBy("image_id").agg(
        (F.min("min_x") + erode).alias("min_x"),
        (F.max("max_x") - erode).alias("max_x"),
        (F.min("min_y") + erode).alias("min_y"),
        (F.max("max_y") - erode).alias("max_y"),
    )


def placement(boxes: DataFrame, settings: ImageSettings) -> DataFrame:
    """Where each box goes on the canvas: adds ``left, top, width`` (pixels) and ``scale``.

    ``boxes`` has the box and the layer's ``ulx, uly, w``. The width decides the scale unless the
    object would then cross the bottom border. A box without extent has a NULL scale.
    """
    canvas, floor = settings.canvas, settings.canvas - settings.bottom_border
    dx, dy = F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")
    pixels = boxes.select(
        "*",
        (F.lit(canvas) * F.col("ulx")).cast("int").alias("left"),
        (F.lit(canvas) * F.col("uly")).cast("int").alias("top"),
        (F.lit(canvas) * F.col("w")).cast("int").alias("width"),
    )
    height = F.try_divide(dy.cast("double") * F.col("width"), dx)
    by_height = F.try_divide((F.lit(floor) - F.col("top")).cast("double"), dy)
    by_width = F.try_divide(F.col("width").cast("double"), dx)
    return pixels.withColumn("scale", F.when(height + F.col("top") > floor, by_height).otherwise(by_width))
