import datetime
import os

import pytest
from pyspark.sql import functions as F

from packshot.functions import dates, paths

NAMES = ["a/b/photo", "photo.png", ".hidden", "..x.y", "dir.d/name", "end.", "a/", "two.dots.jpeg", "ü/ñame.gif", "..."]


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_image_files_follow_the_file_system_rules(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    for name, file, path, stem, ext in df.select(
        "n", paths.image_file("n"), paths.image_path("n"), paths.stem(paths.base_name("n")), paths.extension(paths.base_name("n"))
    ).collect():
        want_stem, want_ext = os.path.splitext(os.path.basename(name))
        want = want_stem + (want_ext or ".jpg")
        assert (file, path, stem, ext) == (want, f"{want[:2]}/{want}", want_stem, want_ext), name


def test_sized_name(spark):
    assert one(spark, paths.sized_name(F.lit("a.b.png"), F.lit(65)))[0] == "a.b_65.png"


@pytest.mark.parametrize(
    "uri, bucket, key",
    [
        ("gs://box/a/b.txt", "box", "a/b.txt"),
        ("gs://box/", "box", ""),
        ("gs://box", None, None),
        ("s3://box/a", None, None),
        ("gs:///a", None, None),
        (None, None, None),
    ],
)
def test_uris(spark, uri, bucket, key):
    text = F.lit(uri).cast("string")
    assert tuple(one(spark, paths.uri_bucket(text), paths.uri_key(text))) == (bucket, key)


def test_other_scheme(spark):
    assert tuple(one(spark, paths.uri_bucket(F.lit("s3://b/k"), "s3"), paths.uri_key(F.lit("s3://b/k"), "s3"))) == ("b", "k")


def test_fill(spark):
    template, day = F.lit("x/<ENV>/<DATE>/<DATE>*"), F.lit("2020-10-02").cast("date")
    assert one(spark, paths.fill_path(template))[0] == "x/<ENV>/<DATE>/<DATE>*"
    assert one(spark, paths.fill_path(template, day))[0] == "x/<ENV>/2020-10-02/2020-10-02*"
    assert one(spark, paths.fill_path(template, day, F.lit("prod"), "/"))[0] == "x/prod/2020/10/02/2020/10/02*"


@pytest.mark.parametrize("divider", ["-", "/", "", "_", "'", "d"])
def test_days(spark, divider):
    text = divider.join(["2020", "02", "29"])
    day = dates.parse_day(F.lit(text), divider)
    assert tuple(one(spark, day, dates.format_day(day, divider))) == (datetime.date(2020, 2, 29), text)


def test_bad_days(spark):
    assert one(spark, dates.parse_day(F.lit(None).cast("string")))[0] is None
    assert one(spark, dates.parse_day(F.lit("2021-02-29"), strict=False))[0] is None
    with pytest.raises(Exception, match="not a date: 2021-02-29"):
        one(spark, dates.parse_day(F.lit("2021-02-29")))
