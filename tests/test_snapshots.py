import datetime

import pytest
from pyspark.sql import functions as F

from packshot.sources import snapshots


def make(tmp_path, days):
    for day in days:
        folder = tmp_path / "feed" / day
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text(day)
    return str(tmp_path / "feed")


def test_latest_day_of_a_folder(spark, tmp_path):
    root = make(tmp_path, ["2020-01-31", "2020-02-03", "2020-02-03x", "2020-13-01", "tmp", "20200401", "old/2021-01-01"])
    listing = snapshots.child_folders(spark, root + "/*")
    assert listing.count() == 7  # children only
    latest = lambda **k: snapshots.latest_day(listing, root, **k).first().day
    assert latest() == datetime.date(2020, 2, 3)
    assert latest(max_day="2020-02-02") == datetime.date(2020, 1, 31)
    assert latest(max_day="2019-12-31") is None


def test_load_most_recent(spark, tmp_path):
    root = make(tmp_path, ["2020-01-28", "2020-01-31"])
    load = lambda path: spark.read.text(path)
    template = root + "/<DATE>/*"
    df, day = snapshots.load_most_recent(load, template, datetime.date(2020, 2, 4))
    assert day == datetime.date(2020, 1, 31) and df.first().value == "2020-01-31"
    df, day = snapshots.load_most_recent(load, template, datetime.date(2020, 2, 4), look_back=3)
    assert df is None and day == datetime.date(2020, 2, 4)
    df, day = snapshots.load_most_recent(load, template, datetime.date(2020, 1, 30), lambda d: d.strftime("%Y-%m-%d"), 2)
    assert day == datetime.date(2020, 1, 28)
    (tmp_path / "feed" / "day=2020-01-30.csv").write_text("x")
    df, day = snapshots.load_most_recent(load, root + "/day=<DATE>.csv", datetime.date(2020, 2, 1))
    assert day == datetime.date(2020, 1, 30) and df.first().value == "x"


def test_load_errors_are_not_missing_days(spark, tmp_path):
    root = make(tmp_path, ["2020-01-28", "2020-01-31"])
    with pytest.raises(Exception, match="nosuch"):
        snapshots.load_most_recent(lambda p: spark.read.text(p).select("nosuch"), root + "/<DATE>", datetime.date(2020, 2, 4))


def test_latest_snapshot(spark, rows):
    days = [("a", "2020-01-01"), ("b", "2020-01-20"), ("c", "2020-01-20"), ("d", "2020-02-01")]
    table = spark.createDataFrame(days, "id string, day string").withColumn("day", F.col("day").cast("date"))
    assert rows(snapshots.latest_snapshot(table, "2020-01-25"), "id") == [("b",), ("c",)]
    assert rows(snapshots.latest_snapshot(table, datetime.date(2020, 1, 5), 4), "id") == [("a",)]
    assert snapshots.latest_snapshot(table, "2020-01-15", 13).count() == 0


def test_latest_snapshot_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "table")
    days = spark.range(60).select("id", F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    snapshots.write_snapshots(days.withColumnRenamed("day", "on"), path, "on")
    found = snapshots.latest_snapshot(snapshots.read_snapshots(spark, path, "id long"), "2020-02-10", 5)
    assert [r.id for r in found.collect()] == [40]
    stage = found._jdf.queryExecution().executedPlan().executedPlan().collectLeaves().apply(0)
    scan = stage.plan().collectLeaves().apply(0)
    assert scan.metrics().apply("numPartitions").value() == 1 and scan.metrics().apply("numFiles").value() == 1


def test_days_replace_their_own_folders(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    make_days = lambda *rs: spark.createDataFrame(rs, "id long, day string").withColumn("day", F.col("day").cast("date"))
    snapshots.write_snapshots(make_days((1, "2020-01-01"), (2, "2020-01-02")), path)
    snapshots.write_snapshots(make_days((3, "2020-01-02"), (4, "2020-01-03")), path)
    assert rows(snapshots.read_snapshots(spark, path, "id long"), "id") == [(1,), (3,), (4,)]
