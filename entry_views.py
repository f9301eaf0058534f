"""The driver tables seen as bundle data: bundle lines, attributes, layouts and images.

Views of ``FIXTURES.md``. Every order line is a product and an order a bundle. ``split`` makes several bundles of an order with
more than 32 line numbers, as the SQL of all queries but ``bundle_images`` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packshot.operators.attributes import PRIMARY_IMAGE
from packshot.operators.skew import skew_join
from packshot.sources.layouts import ImageSettings

# (product type, ulx, uly, w) in stacking order, by the place in the order; type STANDARD has no place.
LAYOUT_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]
LAYOUT = [(t, (4 + 13 * i) / 100, (61 - 14 * i) / 100, (45 - 3 * i) / 100) for i, t in enumerate(LAYOUT_TYPES)]
REPEATED_TYPES = ["PROMO", "SMALL", "PROMO"]
# Small pictures to suit the 8 x 8 images of the embeddings table.
SETTINGS = ImageSettings(
    (5, 8, 20), "jpg", 1, 2, silo_filter_size_cutoff=0.05, silo_min_img_not_background=0.72
)
# a low first cutoff, from which gray levels go up in 51 steps
LOW_SETTINGS = ImageSettings(
    (5, 8, 20), "jpg", 1, 2, silo_filter_size_cutoff=0.05, silo_gray_max_cutoff=0.5, silo_min_img_not_background=0.3
)
SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bundle_text(spark: SparkSession, sf_dir: str, split: bool = False) -> DataFrame:
    """One bundle line per order in column ``value``; ids and lists as in a definition file.

    With ``split`` one per 32 line numbers of an order, so products further apart share no set.
    """
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", *order).withColumn("p_partkey", F.col("l_partkey"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    sold = skew_join(lineitem, part, ["p_partkey"])
    # the first part is the whole order; lines without a number are in no bundle
    part_of_order = F.expr("l_linenumber div 32" if split else "if(l_linenumber is null, null, 0)")
    key = F.concat("l_orderkey", F.lit("-"), part_of_order).alias("line_key")
    items = F.array_sort(F.collect_list(F.struct(*order, "p_type", "p_brand"))).alias("items")
    item = (
        """concat('{"id": "', p.l_partkey, '", "score": ', 10000 - i, """
        """', "productType": "', p.p_type, '", "label": "', p.p_brand, '"}')"""
    )
    return sold.groupBy(key).agg(items).select(
        F.expr(f"concat(line_key, '~!~[', array_join(transform(items, (p, i) -> {item}), ', '), ']')").alias("value")
    )


def attribute_feed(spark: SparkSession, sf_dir: str, which: str = "true") -> DataFrame:
    """Attribute rows of the parts, in the seven-column schema of the feed; ``which`` leaves parts without attributes."""
    part = table(spark, sf_dir, "part").where(which)
    return part.select(
        F.col("p_partkey").cast("string").alias("oms_id"),
        F.expr(
            f"""stack(4, 'p_name', p_name, 'p_brand', p_brand, 'p_type', p_type,
                      '{PRIMARY_IMAGE}', concat(p_brand, '-', p_partkey)) as (attribute_id, attribute_value)"""
        ),
        *[F.lit(None).cast("string").alias(x) for x in ("x1", "x2", "x3", "x4")],
    )


def layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON layout list per brand in column ``value``.

    A layout per part size, its layers per part type; every type comes twice and every bundle type
    ten times, so that the first one has to be found.
    """
    part = table(spark, sf_dir, "part")
    counted = part.groupBy("p_brand", "p_size", "p_type").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("k"))
    layer = (
        """concat('{"productType": "', t.p_type, '", "ulx": 0.', lpad((t.n + SHIFT) % 100, 2, '0'),
                  ', "uly": 0.', lpad((t.k + SHIFT) % 100, 2, '0'), ', "w": 0.', lpad((t.n + t.k + SHIFT) % 100, 2, '0'), '}')"""
    )
    once, again = (f"transform(types, t -> {layer.replace('SHIFT', shift)})" for shift in ("0", "7"))
    layers = f"array_join(concat({once}, {again}), ', ')"
    layouts = counted.groupBy("p_brand", "p_size").agg(F.array_sort(F.collect_list(F.struct("p_type", "n", "k"))).alias("types"))
    layouts = layouts.select(
        "p_brand",
        "p_size",
        F.expr(
            f"""concat('{{"bundle_type": "', p_brand, '/', p_size % 5, '", "bundle_layers": [', {layers}, ']}}')"""
        ).alias("layout"),
    )
    lists = layouts.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_size", "layout"))).alias("l"))
    return lists.select(F.expr("concat('[', array_join(l.layout, ', '), ']')").alias("value"))


def bundle_layout(spark: SparkSession) -> DataFrame:
    """The layout of the order bundles."""
    rows = [("orders", pos, *row) for pos, row in enumerate(LAYOUT)]
    return spark.createDataFrame(rows, "bundle_type string, pos int, product_type string, ulx double, uly double, w double")


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 images: red from the value, the other channels from red."""
    values = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("i", "v"))
    red = F.least(F.lit(255), F.greatest(F.lit(0), F.floor(255 * (F.col("v").cast("double") * 2 + 0.8)))).cast("int")
    return values.select("image_id", "i", red.alias("r")).select(
        "image_id",
        (F.col("i") % 8).alias("x"),
        F.expr("cast(i div 8 as int)").alias("y"),
        "r",
        F.expr("cast(255 - (255 - r) * 3 div 4 as int)").alias("g"),
        F.expr("cast(255 - (255 - r) div 2 as int)").alias("b"),
        F.lit(255).alias("a"),
    )
