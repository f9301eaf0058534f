import json

import pytest

from packshot.operators import products
from packshot.sources.bundles import parse_bundle_lines, read_bundle_lines, write_image_id_mapping

TEXT = [
    'set_1~!~[{"id": "11", "productType": "Oven", "score": "9"}, {"id": "12", "productType": "Fridge"}, '
    '{"id": "13", "productType": "Oven", "label": "Gas"}, {"id": "11", "productType": "Fridge"}]',
    'set_2~!~[{"id": "21", "productType": "Sink & tap"}]~!~ignored',
    "set_3~!~[]",
    "set_4",
    "set_5~!~[{broken",
    'set_6~!~[{"id": "61"}, {"id": "12", "productType": "Fridge"}]',
]


@pytest.fixture(scope="module")
def lines(spark):
    return parse_bundle_lines(spark.createDataFrame([(t,) for t in TEXT], "value string"))


def test_lines_from_text_files(spark, lines, rows, tmp_path):
    (tmp_path / "bundles.txt").write_text("\n".join(TEXT))
    assert rows(read_bundle_lines(spark, str(tmp_path))) == rows(lines)
    found = {r.line_key: r.product_list_json for r in lines.collect()}
    assert found["set_2"] == '[{"id": "21", "productType": "Sink & tap"}]'
    assert found["set_4"] is None and found["set_5"] == "[{broken"


def test_product_rows_skip_empty_and_unreadable_lists(lines, rows):
    assert rows(products.product_rows(lines)) == [
        ("set_1", 0, "11", "Oven"),
        ("set_1", 1, "12", "Fridge"),
        ("set_1", 2, "13", "Oven"),
        ("set_1", 3, "11", "Fridge"),
        ("set_2", 0, "21", "Sink & tap"),
        ("set_6", 0, "61", None),
        ("set_6", 1, "12", "Fridge"),
    ]


def test_first_per_type_keeps_every_bundle_and_key(lines):
    kept = {r.line_key: r.product_list_json for r in products.first_per_type_lines(lines).collect()}
    assert len(kept) == 6 and kept["set_4"] is None and kept["set_5"] is None
    assert json.loads(kept["set_3"]) == []
    assert json.loads(kept["set_1"]) == [
        {"id": "11", "productType": "Oven", "score": "9"},
        {"id": "12", "productType": "Fridge"},
    ]
    assert json.loads(kept["set_6"]) == [{"id": "12", "productType": "Fridge"}]


def test_first_per_type_keeps_value_types(spark):
    text = '[{"id": "1", "productType": "A", "score": 5, "ok": true, "none": null, "in": {"a": [1, 2.5]}}, {"productType": "A"}]'
    lines = spark.createDataFrame([("k", text)], "line_key string, product_list_json string")
    kept = products.first_per_type_lines(lines).first().product_list_json
    assert json.loads(kept) == json.loads(text)[:1]


def test_first_per_type_three_ways(lines, rows):
    nested = products.product_rows(products.first_per_type_lines(lines)).select("line_key", "oms_id", "product_type")
    direct = products.first_per_type(lines)
    relational = products.first_per_type_rows(products.product_rows(lines))
    assert rows(direct) == rows(relational)
    assert rows(nested) == rows(direct.select("line_key", "oms_id", "product_type"))
    again = products.first_per_type_lines(products.first_per_type_lines(lines))
    assert rows(again) == rows(products.first_per_type_lines(lines))


@pytest.mark.parametrize("key", ["set_4", "set_5", "set_6"])
def test_strict_first_per_type_raises(lines, key):
    with pytest.raises(Exception, match=key):
        products.first_per_type_lines(lines.where(f"line_key = '{key}'"), strict=True).collect()


def test_strict_first_per_type_passes_good_lists(lines, rows):
    good = lines.where("line_key in ('set_1', 'set_2', 'set_3')")
    assert rows(products.first_per_type_lines(good, strict=True)) == rows(products.first_per_type_lines(good))


def test_layer_skus_cover_dropped_products(lines, rows):
    assert rows(products.layer_skus(lines)) == [
        ("11", "Fridge"),
        ("11", "Oven"),
        ("12", "Fridge"),
        ("13", "Oven"),
        ("21", "Sink & tap"),
        ("61", None),
    ]


def test_type_groups_in_layout_and_list_order(lines):
    found = products.type_groups(lines, ["Fridge", "Oven"]).collect()
    assert sorted((r.line_key, r.layer, r.product_type, r.sku_list) for r in found) == [
        ("set_1", 0, "Fridge", ["12", "11"]),
        ("set_1", 1, "Oven", ["11", "13"]),
        ("set_6", 0, "Fridge", ["12"]),
    ]


def test_unplaced_products(spark, lines, rows):
    layout = spark.createDataFrame([("Oven",), ("Fridge",)], "product_type string")
    assert rows(products.unplaced_products(products.product_rows(lines), layout)) == [
        ("set_2", 0, "21", "Sink & tap"),
        ("set_6", 0, "61", None),
    ]


def test_sku_counts(spark, rows):
    skus = spark.createDataFrame([("1",), ("2",), ("1",)], "sku string")
    assert rows(products.sku_counts(skus)) == [("1", 2), ("2", 1)]


def test_mapping_has_no_header(spark, rows, tmp_path):
    sets = spark.createDataFrame([("a", "a_0", ["1"]), ("a", "a_1", ["2"])], "line_key string, img_id string, sku_list array<string>")
    write_image_id_mapping(sets, str(tmp_path), "2020-10-20")
    stored = spark.read.csv(f"{tmp_path}/2020-10-20/package_to_image_mapping.csv")
    assert rows(stored) == [("a", "a_0"), ("a", "a_1")]
