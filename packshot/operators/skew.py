"""Equi-joins that stay balanced when one key holds a large part of the left side.

Left rows of a hot key are spread over several salts and the matching right rows are copied to
each salt. Hot keys are looked for first; where there are none, the join is an ordinary one.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a key is hot when it has more than 1/HOT_SHARE of the rows, so there are fewer than HOT_SHARE
HOT_SHARE = 1000
#: and more rows than one task handles at ease
HOT_ROWS = 1_000_000


def find_hot(
    df: DataFrame, on: list[str], share: int = HOT_SHARE, rows: int = HOT_ROWS, weight: str | None = None
) -> DataFrame | None:
    """``(on..., fan)`` of the hot keys of ``df``, or None without any.

    One partial + final aggregate over ``on`` alone; a row counts ``weight`` if given. No more than
    ``share`` keys can each hold more than ``1/share`` of all rows, so the ``share`` largest keys
    include every hot one and no more reach the driver.
    """
    counts = df.groupBy(*on).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    largest = counts.where(F.col("_n") > rows).orderBy(F.desc("_n")).limit(share).collect()
    if not largest:
        return None
    slice_rows = max(rows, counts.agg(F.sum("_n")).first()[0] / share)
    hot = [(*(r[k] for k in on), math.ceil(r["_n"] / slice_rows)) for r in largest if r["_n"] > slice_rows]
    key_types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in on)
    return df.sparkSession.createDataFrame(hot, f"{key_types}, fan int") if hot else None


def plan_by_output(
    left: DataFrame, right: DataFrame, on: list[str], rows_per_task: int = HOT_ROWS
) -> tuple[DataFrame | None, int]:
    """``(hot, tasks)`` for a ``salted_join`` in which both sides have many rows per key.

    Counted by the rows the join reads and gives: a few matches in large tables still take
    as many tasks as the tables. Both sides should be stored tables.
    """
    lefts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_l"))
    rights = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_r"))
    both = lefts.join(rights, on, "full").select(*on, F.coalesce("_l", F.lit(0)).alias("_l"), F.coalesce("_r", F.lit(0)).alias("_r"))
    work = both.select(*on, "_l", "_r", (F.col("_l") * F.col("_r")).alias("_work"))
    read, total = work.agg(F.sum(F.col("_l") + F.col("_r")), F.sum("_work")).first()
    read, total = read or 0, total or 0
    tasks = max(math.ceil(max(read, total) / rows_per_task), 1)
    if total <= rows_per_task:
        return None, tasks
    return find_hot(work.where("_work > 0"), on, rows=4 * rows_per_task, weight="_work"), tasks


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    hot: DataFrame | None,
    salt: Column,
    how: str = "inner",
    tasks: int | None = None,
) -> DataFrame:
    """Join ``left`` and ``right`` on ``on``, splitting the keys of ``hot`` (see ``find_hot``).

    ``salt`` is a BIGINT expression over ``left`` that spreads the rows of one key. Kinds: inner,
    left, left_semi, left_anti (those that never emit an unmatched right row). ``tasks`` fixes the
    number of partitions, for joins that give far more than they read.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    keys = on
    if hot is not None:
        hot = F.broadcast(hot)
        # rows with a NULL key match nothing, so they may go anywhere
        no_key = reduce(or_, [F.col(k).isNull() for k in on])
        fan = F.coalesce("fan", F.when(no_key, HOT_SHARE).otherwise(1))
        left = (
            left.withColumn("_salt_of", salt)
            .join(hot, on, "left")
            .withColumn("_salt", F.pmod("_salt_of", fan).cast("int"))
            .drop("_salt_of", "fan")
        )
        right = (
            right.join(hot, on, "left")
            .withColumn("_salt", F.explode(F.expr("sequence(0, coalesce(fan, 1) - 1)")))
            .drop("fan")
        )
        keys = [*on, "_salt"]
    if tasks is not None:
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.join(right, keys, how).drop("_salt")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    salt: Column | None = None,
    share: int = HOT_SHARE,
    rows: int = HOT_ROWS,
) -> DataFrame:
    """``salted_join`` with the hot keys looked for on ``left``.

    Without ``salt`` rows are spread by their place in the scan, which separates exact copies too;
    that needs a ``left`` whose row order is stable (a scan with narrow steps). After a shuffle,
    pass a hash of columns that differ from row to row.
    """
    salt = F.monotonically_increasing_id() if salt is None else salt
    return salted_join(left, right, on, find_hot(left, on, share, rows), salt, how)
