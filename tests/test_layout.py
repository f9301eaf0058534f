import json

import pytest

from packshot.operators import layout as steps
from packshot.sources.layouts import ImageSettings, image_settings, read_image_settings, read_layouts

LAYOUTS = [
    {"bundle_type": "desk", "bundle_layers": [
        {"productType": "Lamp", "ulx": 0.15, "uly": 0.22, "w": 0.4},
        {"productType": "Chair", "ulx": 0.5, "uly": 0.31, "w": 0.25},
        {"productType": "Lamp", "ulx": 0.75, "uly": 0.8, "w": 0.2},
    ]},
    {"bundle_type": "bath", "bundle_layers": [{"productType": "Towel", "ulx": 0.33, "uly": 0.44, "w": 0.55}]},
    {"bundle_type": "desk", "bundle_layers": [{"productType": "Shelf", "ulx": 0.01, "uly": 0.02, "w": 0.03}]},
]


@pytest.fixture
def layouts(spark, tmp_path):
    (tmp_path / "layouts.json").write_text(json.dumps(LAYOUTS, indent=4))
    return read_layouts(spark, str(tmp_path / "layouts.json"))


def test_first_layout_of_a_type(layouts, rows):
    desk = steps.layout_layers(layouts, "desk")
    assert rows(desk) == [
        ("desk", 0, "Lamp", 0.15, 0.22, 0.4),
        ("desk", 1, "Chair", 0.5, 0.31, 0.25),
        ("desk", 2, "Lamp", 0.75, 0.8, 0.2),
    ]
    assert steps.layout_layers(layouts, "garden").count() == 0
    assert steps.layout_layers(layouts).where("bundle_type = 'bath'").count() == 1


def test_layout_types_in_order(layouts):
    assert steps.layout_types(steps.layout_layers(layouts, "desk")) == ["Lamp", "Chair", "Lamp"]
    with pytest.raises(ValueError, match="no layer"):
        steps.layout_types(steps.layout_layers(layouts, "garden"))
    with pytest.raises(ValueError, match="several bundle types"):
        steps.layout_types(steps.layout_layers(layouts))


def test_first_of_two_files(spark, tmp_path, rows):
    (tmp_path / "b.json").write_text(json.dumps(LAYOUTS[:1]))
    (tmp_path / "a.json").write_text(json.dumps([LAYOUTS[1], LAYOUTS[2]]))
    found = steps.layout_layers(read_layouts(spark, str(tmp_path / "*.json")), "desk")
    assert rows(found) == [("desk", 0, "Shelf", 0.01, 0.02, 0.03)]


def test_first_layer_counts(layouts, rows, spark):
    desk = steps.layout_layers(layouts, "desk")
    images = spark.createDataFrame([("1", "g1", "Lamp"), ("2", "g2", "Sofa")], "oms_id string, img_guid string, product_type string")
    placed = steps.sku_layers(images, desk)
    assert rows(placed, "oms_id", "pos", "ulx", "uly", "w") == [("1", 0, 0.15, 0.22, 0.4)]
    with pytest.raises(Exception, match="no layer for type: Sofa"):
        steps.sku_layers(images, desk, strict=True).collect()
    good = images.where("oms_id = '1'")
    assert rows(steps.sku_layers(good, desk, strict=True)) == rows(placed)


def test_settings(spark, tmp_path):
    path = tmp_path / "settings.json"
    given = {"image_sizes": [20, 48, 16, 90], "bundle_image_filetype": "png", "erode_size": 2, "bottom_border": 7}
    path.write_text(json.dumps(given, indent=1))
    found = read_image_settings(spark, str(path))
    assert found == ImageSettings((20, 48, 16, 90), "png", 2, 7) and found.canvas == 90
    assert (found.silo_filter_size_cutoff, found.silo_white_min_cutoff) == (0.002, 1.0)
    assert (found.silo_gray_max_cutoff, found.silo_min_img_not_background) == (0.95, 0.1)
    path.write_text(json.dumps({**given, "silo_gray_max_cutoff": 0.9}))
    assert read_image_settings(spark, str(path)).silo_gray_max_cutoff == 0.9
    path.write_text(json.dumps({"image_sizes": [9], "erode_size": 2}))
    with pytest.raises(ValueError, match="bundle_image_filetype, bottom_border"):
        read_image_settings(spark, str(path))
    table = image_settings(spark.createDataFrame([([3, 8, 5],)], "image_sizes array<int>"))
    assert table.first().canvas == 8
