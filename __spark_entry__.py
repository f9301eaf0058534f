
from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import entry_sql
import entry_views as views
from entry_views import LAYOUT_TYPES, LOW_SETTINGS, REPEATED_TYPES, SETTINGS, SIDE, table
from packshot.functions import dates, paths
from packshot.operators import attributes as attribute_steps
from packshot.operators import blocks, compose, layers, layout, manifest, products, raster, regions, silhouette
from packshot.operators.product_sets import product_sets
from packshot.plans import jobs
from packshot.runtime import materialise
from packshot.sources import attributes as attribute_source
from packshot.sources import bundles, images, layouts, snapshots


def _lines(spark: SparkSession, sf_dir: str, split: bool = True) -> DataFrame:
    return bundles.parse_bundle_lines(views.bundle_text(spark, sf_dir, split))


def _attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribute_source.attribute_scan(views.attribute_feed(spark, sf_dir))


def _joined(skus: str) -> Column:
    return F.array_join(skus, ",").alias(skus)


# sources, products


def bundle_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


def product_rows(spark, sf_dir):
    return _long_pos(products.product_rows(_lines(spark, sf_dir)))


def _long_pos(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def first_per_type(spark, sf_dir):
    return _long_pos(products.first_per_type(_lines(spark, sf_dir)))


def first_per_type_rows(spark, sf_dir):
    return _long_pos(products.first_per_type_rows(products.product_rows(_lines(spark, sf_dir))))


def first_per_type_lists(spark, sf_dir):
    return products.first_per_type_lines(_lines(spark, sf_dir))


def all_sets(spark, sf_dir):
    return product_sets(_lines(spark, sf_dir), LAYOUT_TYPES).withColumn("sku_list", _joined("sku_list"))


def repeated_type_sets(spark, sf_dir):
    # types that stand in the layout more than once
    found = product_sets(_lines(spark, sf_dir), REPEATED_TYPES)
    return found.withColumn("sku_list", _joined("sku_list"))


def filtered_sets(spark, sf_dir):
    lines = products.first_per_type_lines(_lines(spark, sf_dir))
    return product_sets(lines, LAYOUT_TYPES).withColumn("sku_list", _joined("sku_list"))


def type_groups(spark, sf_dir):
    groups = products.type_groups(_lines(spark, sf_dir), LAYOUT_TYPES)
    return groups.select("line_key", F.col("layer").cast("bigint").alias("layer"), "product_type", _joined("sku_list"))


def layer_skus(spark, sf_dir):
    return products.layer_skus(_lines(spark, sf_dir))


def unplaced_products(spark, sf_dir):
    rows = products.product_rows(_lines(spark, sf_dir))
    return _long_pos(products.unplaced_products(rows, views.bundle_layout(spark)))


def sku_counts(spark, sf_dir):
    sold = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("sku"))
    return products.sku_counts(sold)


def image_id_mapping(spark, sf_dir):
    return bundles.image_id_mapping(product_sets(_lines(spark, sf_dir), LAYOUT_TYPES))


# attributes and layouts


def attribute_scan(spark, sf_dir):
    return _attributes(spark, sf_dir)


def primary_image(spark, sf_dir):
    return attribute_steps.primary_image(_attributes(spark, sf_dir))


def sku_images(spark, sf_dir):
    return attribute_steps.sku_images(_attributes(spark, sf_dir), layer_skus(spark, sf_dir))


def skus_missing(spark, sf_dir):
    sold = table(spark, sf_dir, "lineitem").select(F.concat("l_partkey", F.lit(".0")).alias("sku"))
    feed = views.attribute_feed(spark, sf_dir, "p_size <= 40")  # so that some are missing
    return attribute_steps.skus_missing(sold, attribute_source.attribute_scan(feed))


def layout_layers(spark, sf_dir):
    return _long_pos(layout.layout_layers(layouts.parse_layouts(views.layout_text(spark, sf_dir))))


def first_layer(spark, sf_dir):
    return _long_pos(layout.first_layer(layout.layout_layers(layouts.parse_layouts(views.layout_text(spark, sf_dir)))))


def sku_layers(spark, sf_dir):
    placed = layout.sku_layers(sku_images(spark, sf_dir), views.bundle_layout(spark))
    return _long_pos(placed)


# dates and paths


def date_roundtrip(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    # every seventh text is not a date
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, F.replace(day, F.lit("-"), F.lit("."))).otherwise(day).alias("text")
    )
    parsed = texts.select("o_orderkey", "text", dates.parse_day("text", strict=False).alias("day"))
    return parsed.select(
        "o_orderkey",
        dates.format_day("day", "-").alias("dashed"),
        dates.format_day("day", "/").alias("slashed"),
        F.datediff("day", F.lit("1995-01-01").cast("date")).cast("string").alias("days"),
    )


def uri_parts(spark, sf_dir):
    scheme = F.when(F.col("doc_id") % 5 == 0, "s3").otherwise("gs")
    uri = F.concat(scheme, F.lit("://"), "source", F.lit("/"), "lang", F.lit("/"), "doc_id")
    uris = table(spark, sf_dir, "documents").select("doc_id", uri.alias("uri"))
    return uris.select("doc_id", paths.uri_bucket("uri").alias("bucket"), paths.uri_key("uri").alias("key"))


def path_fill(spark, sf_dir):
    template = F.concat(F.lit("feeds/<ENV>/"), "o_orderstatus", F.lit("/<DATE>/items/<DATE>-*"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", template.alias("template"))
    return orders.select(
        "o_orderkey",
        paths.fill_path("template", day=F.col("o_orderdate").cast("date")).alias("dated"),
        paths.fill_path("template", F.col("o_orderdate").cast("date"), F.col("o_orderpriority")).alias("filled"),
    )


def image_path(spark, sf_dir):
    urls = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.select(
        "page_id",
        paths.image_file("url").alias("file"),
        paths.image_path("url").alias("path"),
        paths.sized_name(paths.image_file("url"), F.lit(65)).alias("sized"),
    )


def latest_day(spark, sf_dir):
    folder = F.when(F.col("o_orderkey") % 10 == 0, "tmp-").otherwise("")
    path = F.concat(F.lit("store/snap/"), folder, F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/part-"), "o_orderkey")
    listing = table(spark, sf_dir, "orders").select(path.alias("path"))
    return snapshots.latest_day(listing, "store/snap", "1998-06-30").select(F.col("day").cast("string").alias("day"))


def latest_snapshot(spark, sf_dir):
    # no orders in the last days before the start date
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"))
    found = snapshots.latest_snapshot(orders, "2001-08-20")
    return found.select("o_orderkey", "o_totalprice", F.col("day").cast("string").alias("day"))


def image_manifest(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    names = manifest.image_manifest(
        products.layer_skus(lines), product_sets(lines, LAYOUT_TYPES), SETTINGS, "pictures", "2020-10-20"
    )
    return names.withColumn("size", F.col("size").cast("bigint"))


# rasters


def gray(spark, sf_dir):
    return raster.gray(views.raster(spark, sf_dir), SETTINGS)


def _non_white(spark, sf_dir):
    return gray(spark, sf_dir).where("is_non_white").select("image_id", "x", "y")


def region_sizes(spark, sf_dir):
    return regions.regions(_non_white(spark, sf_dir), SIDE)


def regions_tiled(spark, sf_dir):
    # tiles of a quarter of the image, so that regions have to be merged
    return regions.regions(_non_white(spark, sf_dir), tile=4)


def region_pixels(spark, sf_dir):
    return regions.region_pixels(_non_white(spark, sf_dir), SIDE)


def filter_mask(spark, sf_dir):
    totals = views.raster(spark, sf_dir).groupBy("image_id").agg(F.count(F.lit(1)).alias("n_pixels"))
    return regions.filter_mask(_non_white(spark, sf_dir), totals, SETTINGS.silo_filter_size_cutoff, SIDE)


def _tiles(spark, sf_dir):
    return silhouette.mask_tiles(views.raster(spark, sf_dir), SETTINGS, SIDE)


def _cutoffs(tiles, settings):
    found = silhouette.foreground_cutoff(silhouette.image_regions(tiles), settings)
    return found.select("image_id", "n_pixels", F.col("level").cast("bigint").alias("level"), F.col("cutoff").cast("bigint").alias("cutoff"), "covered")


def foreground_cutoff(spark, sf_dir):
    return _cutoffs(_tiles(spark, sf_dir), SETTINGS)


def foreground_cutoff_low(spark, sf_dir):
    # 51 gray levels
    return _cutoffs(silhouette.mask_tiles(views.raster(spark, sf_dir), LOW_SETTINGS, SIDE), LOW_SETTINGS)


def foreground_cutoff_tiled(spark, sf_dir):
    return _cutoffs(_small_tiles(spark, sf_dir), SETTINGS)


def _small_tiles(spark, sf_dir):
    # tiles of a quarter of the image, so that regions have to be merged
    return silhouette.mask_tiles(views.raster(spark, sf_dir), SETTINGS, tile=4)


def seeds(spark, sf_dir):
    return _seeds(_tiles(spark, sf_dir))


def seeds_tiled(spark, sf_dir):
    return _seeds(_small_tiles(spark, sf_dir))


def _seeds(tiles):
    found = silhouette.seeds(tiles, silhouette.image_regions(tiles), SETTINGS)
    return found.select("image_id", "x", "y", "seed")


def foreground_of_files(spark, sf_dir):
    # from packed pictures, without pixel rows
    packed = images.to_image_structs(
        views.raster(spark, sf_dir).withColumn("size", F.lit(SIDE)), ["image_id"], "size", alpha=False
    )
    return silhouette.foreground(silhouette.image_tiles(packed, SETTINGS), SETTINGS)


def bbox(spark, sf_dir):
    cutouts = materialise(silhouette.foreground_blocks(_tiles(spark, sf_dir), SETTINGS))
    return raster.bounding_box_of_blocks(cutouts, SETTINGS)


def _image_id() -> Column:
    return F.regexp_extract("img_guid", "([0-9]+)$", 1).cast("bigint")


def placement(spark, sf_dir):
    images_of = sku_images(spark, sf_dir).select("oms_id", "product_type", _image_id().alias("image_id"))
    placed = layout.sku_layers(layers.one_image_per_layer(images_of), views.bundle_layout(spark))
    found = layers.layer_placements(placed, bbox(spark, sf_dir), SETTINGS)
    return found.select("oms_id", "product_type", "left", "top", "width", F.round("scale", 9).alias("scale"))


def layers_missing(spark, sf_dir):
    # attributes of a part of the SKUs only
    feed = attribute_source.attribute_scan(views.attribute_feed(spark, sf_dir, "p_size <= 40"))
    skus = layer_skus(spark, sf_dir)
    images_of = attribute_steps.sku_images(feed, skus).select("oms_id", "product_type", _image_id().alias("image_id"))
    ids = views.raster(spark, sf_dir).select("image_id")
    return layers.layers_missing(skus, images_of, ids, bbox(spark, sf_dir), views.bundle_layout(spark), SETTINGS)


def _layer_blocks(spark, sf_dir, skus=None):
    return jobs.layer_job(
        skus if skus is not None else layer_skus(spark, sf_dir),
        _attributes(spark, sf_dir),
        _tiles(spark, sf_dir),
        views.bundle_layout(spark),
        SETTINGS,
        _image_id(),
    )


def layer_raster(spark, sf_dir):
    return blocks.pixels(_layer_blocks(spark, sf_dir), jobs.LAYER_KEYS)


def resized(spark, sf_dir):
    shrunk = compose.resized(views.raster(spark, sf_dir), ["image_id"], SIDE, [3, 4, 8], alpha=True)
    return shrunk.select("image_id", "size", "x", "y", "r", "g", "b", "a")


def layer_images(spark, sf_dir):
    shrunk = blocks.shrink(_layer_blocks(spark, sf_dir), jobs.LAYER_KEYS, SETTINGS.canvas, list(SETTINGS.sizes), alpha=True)
    return blocks.pixels(shrunk, [*jobs.LAYER_KEYS, "size"])


def _sets_and_layers(spark, sf_dir, split=True):
    # both start from the stored bundle lines, parsed once
    lines = materialise(products.parsed_lines(_lines(spark, sf_dir, split)))
    layer_blocks = materialise(_layer_blocks(spark, sf_dir, products.layer_skus(lines)))
    return product_sets(lines, LAYOUT_TYPES, with_types=True), layer_blocks


def composite(spark, sf_dir):
    # half-transparent layers, so that the order of stacking shows in every channel
    sets, layer_blocks = _sets_and_layers(spark, sf_dir)
    seen_through = blocks.with_alpha(layer_blocks, lambda x, y, r, g, b, a: (r * 7 + x * 31 + y * 17) % 256)
    drawn, names = jobs.bundle_job(sets, materialise(seen_through), blank=False)
    return blocks.pixels(compose.by_name(drawn, names), ["img_id"], alpha=False)


def _bundles(spark, sf_dir, split=True):
    return jobs.bundle_job(*_sets_and_layers(spark, sf_dir, split))


def bundle_pixels(spark, sf_dir):
    return blocks.pixels(compose.by_name(*_bundles(spark, sf_dir)), ["img_id"], alpha=False)


def bundle_images(spark, sf_dir):
    # whole orders, however many line numbers they have
    drawn, names = _bundles(spark, sf_dir, split=False)
    shrunk = blocks.shrink(drawn, ["set_key"], SETTINGS.canvas, list(SETTINGS.sizes), together=True)
    return blocks.pixels(compose.by_name(shrunk, names), ["img_id", "size"], alpha=False)


def image_structs(spark, sf_dir):
    shrunk = blocks.shrink(blocks.pack(views.raster(spark, sf_dir), ["image_id"]), ["image_id"], SIDE, [3, 4, 8])
    packed = images.picture_structs(shrunk, ["image_id"], alpha=False)
    return packed.select("image_id", "height", "width", "nChannels", "mode", F.hex("data").alias("bytes"))


def image_unpacked(spark, sf_dir):
    packed = images.to_image_structs(
        views.raster(spark, sf_dir).withColumn("size", F.lit(SIDE)), ["image_id"], "size", alpha=True
    )
    return images.to_raster(packed)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bundle_lines": bundle_lines,
    "product_rows": product_rows,
    "first_per_type": first_per_type,
    "first_per_type_rows": first_per_type_rows,
    "first_per_type_lists": first_per_type_lists,
    "product_sets": all_sets,
    "product_sets_repeated_types": repeated_type_sets,
    "product_sets_filtered": filtered_sets,
    "type_groups": type_groups,
    "layer_skus": layer_skus,
    "unplaced_products": unplaced_products,
    "sku_counts": sku_counts,
    "image_id_mapping": image_id_mapping,
    "attribute_scan": attribute_scan,
    "primary_image": primary_image,
    "sku_images": sku_images,
    "skus_missing": skus_missing,
    "layout_layers": layout_layers,
    "first_layer": first_layer,
    "sku_layers": sku_layers,
    "date_roundtrip": date_roundtrip,
    "uri_parts": uri_parts,
    "path_fill": path_fill,
    "image_path": image_path,
    "latest_day": latest_day,
    "latest_snapshot": latest_snapshot,
    "image_manifest": image_manifest,
    "gray": gray,
    "regions": region_sizes,
    "regions_tiled": regions_tiled,
    "region_pixels": region_pixels,
    "filter_mask": filter_mask,
    "foreground_cutoff": foreground_cutoff,
    "foreground_cutoff_low": foreground_cutoff_low,
    "foreground_cutoff_tiled": foreground_cutoff_tiled,
    "seeds": seeds,
    "seeds_tiled": seeds_tiled,
    "foreground_of_files": foreground_of_files,
    "bbox": bbox,
    "placement": placement,
    "layers_missing": layers_missing,
    "layer_raster": layer_raster,
    "resized": resized,
    "layer_images": layer_images,
    "composite": composite,
    "bundle_pixels": bundle_pixels,
    "bundle_images": bundle_images,
    "image_structs": image_structs,
    "image_unpacked": image_unpacked,
}


LLM_SQL: dict[str, str] = {}
try:  # the only place that may do without the subpackage
    import corpus_pipeline
    from packshot.llm import queries as llm_queries
except ImportError:
    pass
else:
    QUERIES.update(llm_queries.QUERIES)
    QUERIES["pipeline"] = corpus_pipeline.run
    LLM_SQL.update(llm_queries.SQL)


def entry(spark: SparkSession) -> DataFrame:
    """Which pictures have to be made: every product set of every bundle."""
    return all_sets(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {**entry_sql.oracle_sql(), **LLM_SQL}
