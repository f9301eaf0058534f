"""Orders with more than 32 line numbers are one bundle in the pictures."""

import datetime

import duckdb
import pytest

import __spark_entry__ as entry
import entry_views as views
from check import same
from packshot.operators.product_sets import product_sets

TYPES = ["ECONOMY", "ECONOMY", "LARGE", "LARGE", "STANDARD"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Order 7 has its lines far apart, order 8 the same products side by side."""
    top = tmp_path_factory.mktemp("tables")
    day = datetime.datetime(1996, 1, 1)
    numbers = {7: [1, 2, 33, 70, 31], 8: [1, 2, 4, 5, 3]}
    products = [0, 1, 2, 3, 4]
    lines = [(k, p, 1, n, 10.0, day) for k, ns in numbers.items() for p, n in zip(products, ns, strict=True)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp"),
        "part": ([(p, f"name {p}", f"Brand#{p}", t, 1) for p, t in enumerate(TYPES)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        # dark pictures, no two of one color
        "embeddings": ([(p, [-0.3 + 0.02 * p] * 64, 0) for p in products], "vec_id long, embedding array<float>, label int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{top}/{name}.parquet")
    return str(top)


def test_products_far_apart_share_sets(spark, sf_dir):
    found = entry.queries()["bundle_images"](spark, sf_dir).toPandas()
    assert sorted(found["img_id"].unique()) == [f"{order}-0_{i}" for order in (7, 8) for i in range(4)]
    far, near = (found[found["img_id"].str.startswith(f"{order}-")].assign(img_id=lambda d: d["img_id"].str[1:]) for order in (7, 8))
    assert same(far, near) == "ok"
    shown = found[(found["size"] == 20) & (found["r"] < 255)].groupby("img_id")["r"].unique().map(sorted).map(tuple)
    assert len(set(shown)) == 4 and all(len(colors) == 2 for colors in shown)
    db = duckdb.connect()
    for name in ("lineitem", "part", "embeddings"):
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet/*.parquet'")
    verdict = same(found, db.execute(entry.oracle_sql()["bundle_images"]).df())
    assert verdict.startswith("ok"), verdict


def test_bundles_of_an_order(spark, sf_dir, tmp_path, rows):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_orderkey = 7")
    unnumbered = lines.where("l_linenumber = 1").selectExpr(*[f"cast(null as int) {c}" if c == "l_linenumber" else c for c in lines.columns])
    lines.unionByName(unnumbered).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{sf_dir}/part.parquet").write.parquet(f"{tmp_path}/part.parquet")

    def products(split):
        keys = views.bundle_text(spark, str(tmp_path), split).where("value is not null")
        return rows(keys.selectExpr("split(value, '~')[0]", "size(split(value, 'productType')) - 1"))

    assert products(split=False) == [("7-0", 5)]
    assert products(split=True) == [("7-0", 3), ("7-1", 1), ("7-2", 1)]


def test_a_long_order_of_one_type(spark):
    # rows that carried the list with each set would take 38 GB
    n = 40_000
    item = """concat('{"id": "', 100000 + i, '", "productType": "A"}')"""
    text = f"concat('[', array_join(transform(sequence(1, {n}), i -> {item}), ', '), ']')"
    found = product_sets(spark.range(1).selectExpr("'k' line_key", f"{text} product_list_json"), ["B", "A"], with_types=True)
    numbers = found.selectExpr("cast(split(img_id, '_')[1] as int) i", "cast(sku_list[0] as int) - 100001 sku", "size(sku_list) n", "type_list[0] t")
    assert numbers.where("i = sku and n = 1 and t = 'A'").selectExpr("count(*)", "count(distinct i)", "max(i)").first() == (n, n, n - 1)
    assert found.count() == n
