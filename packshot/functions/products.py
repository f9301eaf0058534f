"""Expressions over product lists (JSON text and parsed arrays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRODUCT_SCHEMA = "array<struct<id:string,productType:string>>"
RAW_ITEM_SCHEMA = "array<string>"


def parse_products(json: Column | str) -> Column:
    """Product list as an array of (id, productType); other keys are ignored, bad JSON is NULL."""
    return F.from_json(json, PRODUCT_SCHEMA)


def raw_products(json: Column | str) -> Column:
    """Product list as an array of JSON texts, one per item, with all keys and value types; bad JSON is NULL."""
    return F.from_json(json, RAW_ITEM_SCHEMA)


def first_positions(types: Column) -> Column:
    """1-based positions of the first entry of each distinct non-NULL value, ascending."""
    distinct = F.filter(F.array_distinct(types), lambda t: t.isNotNull())
    return F.transform(distinct, lambda t: F.array_position(types, t).cast("int"))


def pick(items: Column, positions: Column) -> Column:
    """The items at the given 1-based positions."""
    return F.transform(positions, lambda p: F.get(items, p - 1))
