"""Stacking layers into bundle pictures, and scaling pictures to the stored sizes.

The work is done on blocks (``operators/blocks.py``); ``stack``, ``stack_opaque`` and ``resized`` are the
same steps on pixel rows, for raster tables.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packshot.operators import blocks
from packshot.operators.skew import find_hot, plan_by_output, salted_join
from packshot.runtime import materialise

#: bytes of cells, and blocks, that a task joins
TASK_BYTES = 64 << 20
TASK_BLOCKS = 100_000
#: the key of the picture without layers, in hexadecimal digits
NOTHING = "00" * 16


def one_set_per_picture(sets: DataFrame) -> DataFrame:
    """One product set per ``img_id``: lines that share a key would draw the same picture twice."""
    return sets.groupBy("img_id").agg(F.min(F.struct("sku_list", "type_list")).alias("s")).select("img_id", "s.*")


def with_set_key(sets: DataFrame) -> DataFrame:
    """``sets`` with ``set_key``, a digest of what the set holds: equal sets make equal pictures."""
    content = F.to_json(F.struct("sku_list", "type_list"))
    return sets.withColumn("set_key", F.unhex(F.md5(content)))


def set_dictionary(sets: DataFrame) -> DataFrame:
    """``(set_key, sku_list, type_list)`` of the distinct sets."""
    return sets.select("set_key", "sku_list", "type_list").dropDuplicates(["set_key"])


def shown_layers(sets: DataFrame, layers: DataFrame) -> DataFrame:
    """``(img_id, set_key, sku_list, type_list)`` of the sets with layers: the members that ``layers`` draws, lowest first.

    Members without a layer show nothing, so only those that have one are looked up in ``layers`` and grouped again.
    ``set_key`` is a digest of these members, their places and the length of the set: equal sets make equal pictures.
    """
    on = ["oms_id", "product_type"]
    member = F.posexplode(F.arrays_zip("sku_list", "type_list")).alias("z", "m")
    members = sets.select("img_id", F.size("sku_list").alias("n"), member).select(
        "img_id", "n", "z", F.col("m.sku_list").alias("oms_id"), F.col("m.type_list").alias("product_type")
    )
    members = materialise(members)
    salt = F.xxhash64("img_id")
    known = salted_join(members, layers.select(*on).distinct(), on, find_hot(members, on), salt, "left_semi")
    grouped = known.groupBy("img_id").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("z", *on))).alias("m"))
    key = F.unhex(F.md5(F.to_json(F.struct("n", "m")))).alias("set_key")
    return grouped.select("img_id", key, F.col("m.oms_id").alias("sku_list"), F.col("m.product_type").alias("type_list"))


def shared_names(sets: DataFrame) -> bool:
    """Whether an ``img_id`` may come more than once; hashes of the names are counted."""
    counts = sets.groupBy(F.xxhash64("img_id").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return not counts.where("n > 1").isEmpty()


def by_name(drawn: DataFrame, names: DataFrame) -> DataFrame:
    """``drawn`` (by ``set_key``) once for each ``img_id`` of ``names`` that shows it."""
    hot = find_hot(names, ["set_key"])
    found = salted_join(names.select("img_id", "set_key"), drawn, ["set_key"], hot, F.xxhash64("img_id"))
    return found.drop("set_key")


def set_members(sets: DataFrame, key: str = "img_id") -> DataFrame:
    """``(img_id, z, oms_id, product_type)``, lowest layer first."""
    return sets.select(key, F.posexplode(F.arrays_zip("sku_list", "type_list")).alias("z", "m")).select(
        key, "z", F.col("m.sku_list").alias("oms_id"), F.col("m.type_list").alias("product_type")
    )


def blank_pictures(sets: DataFrame) -> DataFrame:
    """One white pixel below all layers of every picture, so that a picture without layers shows up."""
    white = [F.lit(255).alias(c) for c in "rgba"]
    return sets.select("img_id", F.lit(-1).alias("z"), F.lit(0).alias("x"), F.lit(0).alias("y"), *white)


def blank_blocks(sets: DataFrame, key: str) -> DataFrame:
    """``blank_pictures`` as blocks."""
    zero = F.lit(0)
    return sets.select(key, F.lit(-1).alias("z"), zero.alias("tx"), zero.alias("ty"), F.expr(blocks.BLANK).alias("cells"))


def gather_layers(members: DataFrame, layers: DataFrame, rows_per_task: int = 1_000_000) -> DataFrame:
    """What ``layers`` (pixels or blocks by ``oms_id, product_type``) have for the members of every picture.

    Every member of a set brings its whole layer, so the result is far larger than either
    input. The join is therefore cut by the rows it gives: the number of tasks follows from the
    total, and a product that is part of very many sets is spread over several. Both inputs should
    be stored tables, since their counts are taken first.
    """
    return _gathered(members, layers, rows_per_task)[0]


def _gathered(members: DataFrame, layers: DataFrame, rows_per_task: int) -> tuple[DataFrame, int]:
    on = ["oms_id", "product_type"]
    hot, tasks = plan_by_output(members, layers, on, rows_per_task)
    salt = F.xxhash64(*[c for c in members.columns if c not in on])
    return salted_join(members, layers, on, hot, salt, tasks=tasks).drop(*on), tasks


def draw_sets(dictionary: DataFrame, layers: DataFrame, blank: bool = True) -> DataFrame:
    """Blocks ``(set_key, tx, ty, cells)`` of the pictures of distinct sets, from stored layer blocks.

    Two shuffles, of blocks: layers meet the sets that have them, and the layers of a picture are stacked. ``blank`` adds the
    picture without layers, :data:`NOTHING`.
    """
    mean = layers.agg(F.avg(F.size("cells"))).first()[0] or 1
    per_task = max(1, min(TASK_BLOCKS, math.ceil(TASK_BYTES / (8 * mean))))
    gathered, tasks = _gathered(set_members(dictionary, "set_key"), layers, per_task)
    if blank:
        nothing = dictionary.sparkSession.range(1).select(F.unhex(F.lit(NOTHING)).alias("set_key"))
        gathered = gathered.unionByName(blank_blocks(dictionary.select("set_key").union(nothing), "set_key"))
    return blocks.stack(gathered, "set_key", tasks)


def stack(pixels: DataFrame, n_layers: int) -> DataFrame:
    """Lay the pixels of each picture over opaque white, lowest ``z`` first: ``(img_id, x, y, r, g, b)``.

    ``z`` runs below ``n_layers``, the number of layers of the layout; a higher one raises. Cells without a pixel stay
    white and give no row. Pixels are packed into blocks first.
    """
    beyond = F.raise_error(F.concat(F.lit(f"a layer beyond the {n_layers} of the layout: "), F.col("z"))).cast("int")
    return stack_opaque(pixels.withColumn("z", F.when(F.col("z") < n_layers, F.col("z")).otherwise(beyond)))


def stack_opaque(pixels: DataFrame) -> DataFrame:
    """``stack`` without a check of ``z``; where layers are opaque the highest one shows."""
    layers = blocks.pack(pixels, ["img_id", "z"])
    return blocks.pixels(blocks.stack(layers, "img_id"), ["img_id"], alpha=False)


def resized(raster: DataFrame, keys: list[str], side: int, sizes: list[int], alpha: bool = False) -> DataFrame:
    """Shrink square pictures to each of ``sizes``: adds ``size``, averages blocks, rounds down.

    Pixels without a row count as white (transparent white with ``alpha``), so only the drawn part
    of a picture is read. ``size`` equal to ``side`` passes the pixels through.
    """
    shrunk = blocks.shrink(blocks.pack(raster, keys), keys, side, sizes, alpha)
    return blocks.pixels(shrunk, [*keys, "size"], alpha)
