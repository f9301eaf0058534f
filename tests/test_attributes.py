from packshot.operators import attributes as steps
from packshot.operators.attributes import PRIMARY_IMAGE
from packshot.plans.jobs import audit
from packshot.sources import attributes as source

FEED = [
    "oms_id,attribute_id,attribute_value,a,b,c,d",
    f"1,{PRIMARY_IMAGE},img-1,,,,",
    f"1,{PRIMARY_IMAGE},img-1b,,,,",
    "1,colour,red,x,,,",
    f'2,{PRIMARY_IMAGE},"img,2",,,,',
    "3,colour,blue,,,,",
]


def feed(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("\n".join(FEED))
    return source.read_attributes(spark, str(tmp_path / "feed.csv"))


def test_feed_has_no_header(spark, rows, tmp_path):
    found = rows(feed(spark, tmp_path))
    assert len(found) == 6 and ("oms_id", "attribute_id", "attribute_value") in found


def test_primary_image(spark, rows, tmp_path):
    assert rows(steps.primary_image(feed(spark, tmp_path))) == [("1", "img-1"), ("1", "img-1b"), ("2", "img,2")]


def test_filter_reaches_the_scan(spark, tmp_path):
    plan = steps.primary_image(feed(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(attribute_id" in plan and "ReadSchema: struct<oms_id:string,attribute_id:string,attribute_value:string>" in plan


def test_sku_images_multiply_images_and_types(spark, rows, tmp_path):
    skus = spark.createDataFrame([("1", "Saw"), ("1", "Drill"), ("2", "Saw"), ("3", "Saw"), ("4", "Saw")], "oms_id string, product_type string")
    assert rows(steps.sku_images(feed(spark, tmp_path), skus)) == [
        ("1", "img-1", "Drill"),
        ("1", "img-1", "Saw"),
        ("1", "img-1b", "Drill"),
        ("1", "img-1b", "Saw"),
        ("2", "img,2", "Saw"),
    ]


def test_missing_skus_keep_repeats(spark, rows, tmp_path):
    (tmp_path / "skus.csv").write_text("name,sku\na,1.0\nb,7.0\nc,7.0\nd,8\n")
    (tmp_path / "attributes.csv").write_text("\n".join(FEED).replace(",a,b,c,d", ",x1,x2,x3,x4"))
    skus = source.read_sku_list(spark, str(tmp_path / "skus.csv"))
    known = source.read_attributes_with_header(spark, str(tmp_path / "attributes.csv"))
    assert rows(steps.skus_missing(skus, known)) == [("7",), ("7",), ("8",)]
    missing, counts = audit(skus, known)
    assert rows(missing) == [("7",), ("7",), ("8",)]
    assert rows(counts) == [("1.0", 1), ("7.0", 2), ("8", 1)]
