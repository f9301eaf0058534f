"""Connected components of links stored as a table, by alternating large and small stars.

Every round is written to the shared folder. Nothing is collected but a count, a checksum and, of more links than a task
takes, the few nodes that very many of them share: the links of such a hub are spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packshot.operators.skew import find_hot, salted_join
from packshot.runtime import materialise

HOT_LINKS = 1_000_000


def _with_least(edges: DataFrame, least: DataFrame, many: bool) -> DataFrame:
    hot = find_hot(edges, ["u"], rows=HOT_LINKS) if many else None
    return salted_join(edges, least, ["u"], hot, F.xxhash64("v"))


def _large_star(edges: DataFrame, many: bool) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_least(both, least, many).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, many: bool) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    inner = _with_least(down, least, many).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node that stands in ``links`` (columns ``u, v``): the least node reachable."""
    edges = materialise(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        many = state[0] > HOT_LINKS
        # a hub of many links is looked for in stored ones
        star = materialise(_large_star(edges, many)) if many else _large_star(edges, many)
        edges = materialise(_small_star(star, many).where("u != v").distinct())
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
