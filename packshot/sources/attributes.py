"""Attribute feed and SKU list (CSV)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ATTRIBUTE_SCHEMA = (
    "oms_id string, attribute_id string, attribute_value string, x1 string, x2 string, x3 string, x4 string"
)


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    """``(oms_id, attribute_id, attribute_value)``; files have no header, so a header line is a data row."""
    return attribute_scan(spark.read.schema(ATTRIBUTE_SCHEMA).option("sep", ",").csv(path))


def attribute_scan(feed: DataFrame) -> DataFrame:
    """The three columns in use of a feed table with the seven-column schema."""
    return feed.select("oms_id", "attribute_id", "attribute_value")


def read_sku_list(spark: SparkSession, path: str, column: str = "sku") -> DataFrame:
    """``sku`` as text from a CSV with header; other columns are not kept."""
    return spark.read.option("header", True).csv(path).select(column).toDF("sku")


def read_attributes_with_header(spark: SparkSession, path: str) -> DataFrame:
    """An attribute feed that does have a header, for the audit."""
    return spark.read.option("header", True).csv(path).select("oms_id", "attribute_id", "attribute_value")
