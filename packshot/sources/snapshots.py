"""Data that lies below one directory per day, or in a table with a day column."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packshot.functions.paths import DATE_MARK


def child_folders(spark: SparkSession, pattern: str) -> DataFrame:
    """``path`` of everything that matches a glob pattern, such as the children of a root by ``root/*``.

    One listing per pattern; what lies below the matches is not looked at.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(conf).globStatus(path) or []
    return spark.createDataFrame([(s.getPath().toString(),) for s in found], "path string")


def _named_days(listing: DataFrame, root: str) -> DataFrame:
    """``day`` (text) of each path whose first component below the first ``root`` has the form of a date."""
    escaped = re.sub(r"([^\w/])", r"\\\1", root.strip("/"))
    child = rf"^(?>(?:.*?/)??{escaped}/)(\d{{4}}-\d{{2}}-\d{{2}})(?:/|$)"
    return listing.select(F.regexp_extract("path", child, 1).alias("day")).where("day != ''")


def dated_children(listing: DataFrame, root: str) -> DataFrame:
    """``day`` (text) of each path whose first component below ``root`` is a date."""
    return _named_days(listing, root).where(F.try_to_date("day", "yyyy-MM-dd").isNotNull())


def latest_day(listing: DataFrame, root: str, max_day: str | None = None) -> DataFrame:
    """One row ``day``: the latest dated child of ``root`` not after ``max_day``; NULL if none."""
    days = _named_days(listing, root).distinct()  # few, however many paths there are
    if max_day is not None:
        days = days.where(F.col("day") <= max_day)
    return days.agg(F.max(F.try_to_date("day", "yyyy-MM-dd")).alias("day"))


def latest_snapshot(
    table: DataFrame, start: datetime.date | str, max_retries: int = 30, day: str = "day"
) -> DataFrame:
    """Rows of the latest day that has any, from ``start`` back over at most ``max_retries`` days.

    The day is a subquery of one value. With ``day`` as a partition column (:func:`write_snapshots`) it is found
    first and selects the one folder that is read; the days themselves come from the folders of the window alone.
    """
    first: Column = F.lit(str(start)).cast("date")
    window = table.where(F.col(day).between(F.date_sub(first, max_retries), first))
    return window.where(F.col(day) == window.agg(F.max(day)).scalar())


def write_snapshots(table: DataFrame, folder: str, day: str = "day") -> None:
    """Store rows below one ``day=`` folder per day; the days of ``table`` replace their own folders."""
    writer = table.withColumnRenamed(day, "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(folder)


def read_snapshots(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of ``write_snapshots`` with ``day`` as a date; ``schema`` names the other columns."""
    return spark.read.schema(f"{schema}, day date").parquet(folder)


def load_most_recent(
    load: Callable[[str], DataFrame],
    template: str,
    start: datetime.date,
    format_date: Callable[[datetime.date], str] = str,
    look_back: int = 30,
) -> tuple[DataFrame | None, datetime.date]:
    """Load the path of the latest day that exists, from ``start`` back over ``look_back`` days.

    What matches ``template`` with any date is listed once; ``(None, start)`` if no day of the window is
    there. An error of ``load`` is not taken for a missing day.
    """
    spark = SparkSession.active()
    window = [start - datetime.timedelta(days=n) for n in range(look_back + 1)]
    # the folder that the date names, whatever follows it in the template
    head, _, tail = template.partition(DATE_MARK)
    level = head + "*" + tail.partition("/")[0]
    names = {r.path.rstrip("/").rpartition("/")[2] for r in child_folders(spark, level).toLocalIterator()}
    prefix, suffix = head.rpartition("/")[2], tail.partition("/")[0]
    for day in window:
        if prefix + format_date(day) + suffix in names:
            return load(template.replace(DATE_MARK, format_date(day))), day
    return None, start
