"""Bundle definitions: one per text line, ``line key ~!~ JSON list of products``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packshot.functions.paths import MAPPING_FILE

# Fixed value: separator of a bundle line.
SEPARATOR = "~!~"


def read_bundle_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_key, product_list_json)`` of the text files at ``path``."""
    return parse_bundle_lines(spark.read.text(path))


def parse_bundle_lines(text: DataFrame) -> DataFrame:
    """Split the ``value`` column; a line without separator has a NULL list, further items are dropped."""
    parts = text.select(F.split("value", SEPARATOR).alias("parts"))
    return parts.select(F.get("parts", F.lit(0)).alias("line_key"), F.get("parts", F.lit(1)).alias("product_list_json"))


def image_id_mapping(sets: DataFrame) -> DataFrame:
    """Which pictures belong to which bundle."""
    return sets.select("line_key", "img_id")


def write_image_id_mapping(sets: DataFrame, folder: str, day: str) -> None:
    """The mapping as CSV without header below the day's folder (a directory of part files)."""
    image_id_mapping(sets).write.mode("overwrite").option("header", False).csv(f"{folder}/{day}/{MAPPING_FILE}")
