"""Layouts: ``(bundle_type, pos, product_type, ulx, uly, w)``, ``pos`` being the stacking order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packshot.runtime import broadcast_if_small


def layout_layers(layouts: DataFrame, bundle_type: str | None = None) -> DataFrame:
    """Layers of the first layout of each bundle type, or of one bundle type (no rows if unknown).

    ``layouts`` is ``(file, layout_idx, bundle_type, bundle_layers)`` as read by ``sources.layouts``;
    the first is the one that comes first in the first file by name.
    """
    if bundle_type is not None:
        layouts = layouts.where(F.col("bundle_type") == bundle_type)
    first = layouts.groupBy("bundle_type").agg(F.min_by("bundle_layers", F.struct("file", "layout_idx")).alias("layers"))
    return first.select("bundle_type", F.posexplode("layers").alias("pos", "layer")).select(
        "bundle_type",
        "pos",
        F.col("layer.productType").alias("product_type"),
        F.col("layer.ulx").alias("ulx"),
        F.col("layer.uly").alias("uly"),
        F.col("layer.w").alias("w"),
    )


def first_layer(layers: DataFrame) -> DataFrame:
    """First layer per bundle and product type."""
    first = F.min_by(F.struct("pos", "ulx", "uly", "w"), "pos").alias("layer")
    return layers.groupBy("bundle_type", "product_type").agg(first).select("bundle_type", "product_type", "layer.*")


def layout_types(layers: DataFrame) -> list[str]:
    """Product types of one layout in stacking order, for ``product_sets``.

    A layout is configuration, as long as its file. None or several of them raise.
    """
    rows = layers.select("bundle_type", "pos", "product_type").collect()
    kinds = sorted({str(r.bundle_type) for r in rows})
    if len(kinds) != 1:
        raise ValueError(f"several bundle types: {', '.join(kinds)}" if kinds else "no layer: is the bundle type in the layouts?")
    return [r.product_type for r in sorted(rows, key=lambda r: r.pos)]


def sku_layers(sku_images: DataFrame, layers: DataFrame, strict: bool = False) -> DataFrame:
    """Layer of each SKU image by product type: adds ``pos, ulx, uly, w`` of one layout.

    The first layer of a type counts. SKUs whose type has no layer drop out, or raise when
    ``strict``.
    """
    first = broadcast_if_small(first_layer(layers).drop("bundle_type"))
    if not strict:
        return sku_images.join(first, "product_type")
    joined = sku_images.join(first, "product_type", "left")
    message = F.concat(F.lit("no layer for type: "), F.coalesce("product_type", F.lit("NULL")))
    pos = F.when(F.col("pos").isNull(), F.raise_error(message).cast("int")).otherwise(F.col("pos"))
    return joined.withColumn("pos", pos)
