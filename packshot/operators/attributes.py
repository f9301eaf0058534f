"""Steps on the attribute feed ``(oms_id, attribute_id, attribute_value)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packshot.operators.skew import skew_join

# Fixed value: id of the attribute that names a SKU's primary image.
PRIMARY_IMAGE = "645296e8-a910-43c3-803c-b51d3f1d4a89"


def primary_image(attributes: DataFrame, attribute_id: str = PRIMARY_IMAGE) -> DataFrame:
    """``(oms_id, img_guid)`` of the rows that carry the primary image attribute."""
    return attributes.where(F.col("attribute_id") == attribute_id).select(
        "oms_id", F.col("attribute_value").alias("img_guid")
    )


def sku_images(attributes: DataFrame, skus: DataFrame, attribute_id: str = PRIMARY_IMAGE) -> DataFrame:
    """``(oms_id, img_guid, product_type)``: primary images of the SKUs used in bundles.

    Every attribute row of a SKU counts, and every type it is used as; SKUs without image drop out.
    """
    return skew_join(primary_image(attributes, attribute_id), skus, ["oms_id"]).select(
        "oms_id", "img_guid", "product_type"
    )


def skus_missing(skus: DataFrame, attributes: DataFrame) -> DataFrame:
    """SKUs of a list without any attribute row, repeats kept, cut at the first dot."""
    ids = skus.select(F.split_part(F.col("sku").cast("string"), F.lit("."), F.lit(1)).alias("sku"))
    known = attributes.select(F.col("oms_id").alias("sku")).distinct()
    return skew_join(ids, known, ["sku"], "left_anti")
