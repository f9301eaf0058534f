"""Every product set of a bundle: one product per type, in layout order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packshot.functions.products import parse_products
from packshot.operators.products import grouped_by_type, parsed_lines
from packshot.runtime import materialise

#: sets of one bundle that a single task writes; a bundle with more is cut into blocks
BLOCK = 1 << 16
#: sets of one bundle up to which each may carry the whole list, which is no longer than sets and layout types together
CARRIED = 1 << 10


def product_sets(
    lines: DataFrame, layout_types: list[str], strict: bool = False, with_types: bool = False, block: int = BLOCK
) -> DataFrame:
    """``(line_key, img_id, sku_list)`` with every combination of one SKU per layout type.

    Set ``i`` takes from group ``j`` the SKU ``(i div stride_j) mod n_j``, where ``stride_j`` is the
    product of the sizes of the groups before it: the first layout type varies fastest and the
    numbers run from 0 without gaps. A bundle without placed products has one empty set. Types
    outside the layout are ignored (``unplaced_products`` lists them) or raise when ``strict``.

    Each list is parsed once and stored with its groups. How a bundle is expanded depends on its number
    of sets alone: one with at most ``CARRIED`` sets where it is stored, all others in blocks of up to ``block`` sets that are
    spread over the cluster. There the SKUs of a set are picked before the sets become rows, so that none carries a long list.
    ``with_types`` adds ``type_list``, parallel to ``sku_list``.
    """
    if not layout_types:
        raise ValueError("a layout without product types")
    if strict:
        lines = lines.withColumn("product_list_json", _all_placed(layout_types))
    sized = materialise(_sized(lines, layout_types))
    carried = min(block, CARRIED)
    types = F.col("groups.product_type").alias("type_list")
    picked = "transform(groups, g -> get(g.ids, cast((i div g.stride) % size(g.ids) as int)))"
    few = (
        sized.where(F.col("n_sets") <= carried)
        .select("line_key", "groups", F.explode(F.expr("sequence(0L, n_sets - 1)")).alias("i"))
        .select("line_key", "i", F.expr(picked).alias("sku_list"), types)
    )
    numbers = f"sequence(start, least(start + {block - 1}L, n_sets - 1))"
    many = (
        sized.where(F.col("n_sets") > carried)
        .select("line_key", "groups", "n_sets", types, F.explode(F.expr(f"sequence(0L, n_sets - 1, {block}L)")).alias("start"))
        .repartition("line_key", "start")
        .select("line_key", "type_list", F.explode(F.expr(f"transform({numbers}, i -> struct(i, {picked} as sku_list))")).alias("s"))
        .select("line_key", "s.i", "s.sku_list", "type_list")
    )
    columns = ["line_key", F.concat_ws("_", "line_key", F.col("i").cast("string")).alias("img_id"), "sku_list"]
    if with_types:
        columns.append("type_list")
    return few.unionAll(many).select(*columns)


def _sized(lines: DataFrame, layout_types: list[str]) -> DataFrame:
    """``(line_key, groups, n_sets)`` of every list, NULL for unreadable ones."""
    grouped = parsed_lines(lines).select("line_key", grouped_by_type("products", layout_types).alias("groups"))
    return grouped.select("line_key", _with_strides().alias("groups"), _set_count().alias("n_sets"))


def _set_count() -> Column:
    """Number of sets; more than a BIGINT holds raises instead of wrapping round."""
    n = F.expr("aggregate(groups, 1L, (n, g) -> try_multiply(n, cast(size(g.ids) as bigint)))")
    message = F.concat(F.lit("too many product sets: "), F.coalesce("line_key", F.lit("NULL")))
    return F.when(F.col("groups").isNotNull(), F.coalesce(n, F.raise_error(message).cast("bigint")))


def _with_strides() -> Column:
    return F.expr(
        """transform(groups, (g, j) -> struct(
               g.product_type as product_type, g.ids as ids,
               aggregate(slice(groups, 1, j), 1L, (s, b) -> try_multiply(s, cast(size(b.ids) as bigint))) as stride))"""
    )


def _all_placed(layout_types: list[str]) -> Column:
    json, products = F.col("product_list_json"), parse_products("product_list_json")
    key = F.coalesce("line_key", F.lit("NULL"))
    stray = F.exists(products, lambda p: ~F.coalesce(p["productType"].isin(layout_types), F.lit(False)))
    return (
        F.when(products.isNull(), F.raise_error(F.concat(F.lit("unreadable product list: "), key)))
        .when(stray, F.raise_error(F.concat(F.lit("product type not in layout: "), key)))
        .otherwise(json)
    )
