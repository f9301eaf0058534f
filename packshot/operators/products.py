"""Steps on bundle lines ``(line_key, product_list_json)`` and product rows.

A product row is ``(line_key, pos, oms_id, product_type)``, ``pos`` counting from 0. A bundle is
one line of text, so everything that looks at a single bundle works inside the row, without a
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packshot.functions.products import (
    first_positions,
    parse_products,
    pick,
    raw_products,
)
from packshot.runtime import broadcast_if_small


def parsed_lines(lines: DataFrame) -> DataFrame:
    """``(line_key, products)``: bundle lines with their lists parsed, NULL for unreadable ones.

    To be stored where several steps start from the lines: ``product_rows`` and ``product_sets`` take them as well.
    """
    if "products" in lines.columns:
        return lines.select("line_key", "products")
    return lines.select("line_key", parse_products("product_list_json").alias("products"))


def product_rows(lines: DataFrame) -> DataFrame:
    """One row per product; a bundle with an empty or unreadable list gives none."""
    parsed = F.col("products") if "products" in lines.columns else parse_products("product_list_json")
    return lines.select("line_key", F.posexplode(parsed).alias("pos", "product")).select(
        "line_key", "pos", F.col("product.id").alias("oms_id"), F.col("product.productType").alias("product_type")
    )


def first_per_type_lines(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Keep the first product of each type in every list, with all its keys and value types, in list order.

    One line per bundle stays, even with an empty list. ``strict`` raises on unreadable lists and
    on products without a type; otherwise the list becomes NULL and the product is left out.
    """
    json = F.col("product_list_json")
    typed = lines.select("line_key", raw_products(json).alias("items"), parse_products(json)["productType"].alias("types"))
    kept = F.concat(F.lit("["), F.array_join(pick(F.col("items"), first_positions(F.col("types"))), ","), F.lit("]"))
    if strict:
        key = F.coalesce(F.col("line_key"), F.lit("NULL"))
        kept = (
            F.when(F.col("items").isNull(), F.raise_error(F.concat(F.lit("unreadable product list: "), key)))
            .when(
                F.exists("types", lambda t: t.isNull()),
                F.raise_error(F.concat(F.lit("product without type: "), key)),
            )
            .otherwise(kept)
        )
    return typed.select("line_key", kept.alias("product_list_json"))


def first_per_type(lines: DataFrame) -> DataFrame:
    """The kept products of ``first_per_type_lines`` as product rows, with their old positions."""
    parsed = lines.select("line_key", parse_products("product_list_json").alias("items"))
    firsts = first_positions(F.col("items.productType"))
    return (
        parsed.select("line_key", "items", F.explode(firsts).alias("p"))
        .select("line_key", (F.col("p") - 1).alias("pos"), F.get("items", F.col("p") - 1).alias("product"))
        .select("line_key", "pos", F.col("product.id").alias("oms_id"), F.col("product.productType").alias("product_type"))
    )


def first_per_type_rows(rows: DataFrame) -> DataFrame:
    """First product per (bundle, type) of product rows that are no longer in one line.

    An aggregate with map-side combine, not a window: a large bundle never meets in one task.
    """
    return (
        rows.where(F.col("product_type").isNotNull())
        .groupBy("line_key", "product_type")
        .agg(F.min("pos").alias("pos"), F.min_by("oms_id", "pos").alias("oms_id"))
        .select("line_key", "pos", "oms_id", "product_type")
    )


def layer_skus(lines: DataFrame) -> DataFrame:
    """Distinct (SKU, type) pairs over all bundles, before any product is dropped."""
    return product_rows(lines).select("oms_id", "product_type").dropDuplicates()


def type_groups(lines: DataFrame, layout_types: list[str]) -> DataFrame:
    """Per bundle and layout type, the SKUs in list order: ``(line_key, layer, product_type, sku_list)``.

    Types without a product give no row; ``layer`` is the place of the type in the layout.
    """
    parsed = lines.select("line_key", parse_products("product_list_json").alias("products"))
    groups = grouped_by_type("products", layout_types)
    return parsed.select("line_key", F.explode(groups).alias("g")).select(
        "line_key",
        F.col("g.layer").alias("layer"),
        F.col("g.product_type").alias("product_type"),
        F.col("g.ids").alias("sku_list"),
    )


def grouped_by_type(products: str, layout_types: list[str]) -> Column:
    """Array of (layer, product_type, ids) in layout order, from a column of parsed products.

    The column has to be parsed in a step of its own, as it is read once per type.
    """
    types = F.array(*[F.struct(F.lit(i).alias("layer"), F.lit(t).alias("product_type")) for i, t in enumerate(layout_types)])
    groups = F.transform(
        types,
        lambda t: F.struct(
            t["layer"].alias("layer"),
            t["product_type"].alias("product_type"),
            F.transform(
                F.filter(products, lambda p: p["productType"] == t["product_type"]), lambda p: p["id"]
            ).alias("ids"),
        ),
    )
    return F.when(F.col(products).isNotNull(), F.filter(groups, lambda g: F.size(g["ids"]) > 0))


def unplaced_products(rows: DataFrame, layout: DataFrame) -> DataFrame:
    """Product rows whose type has no place in the layout (a missing type included)."""
    types = broadcast_if_small(layout.select("product_type").distinct())
    return rows.join(types, "product_type", "left_anti").select("line_key", "pos", "oms_id", "product_type")


def sku_counts(skus: DataFrame) -> DataFrame:
    """How often each SKU occurs."""
    return skus.groupBy("sku").agg(F.count(F.lit(1)).alias("n"))
