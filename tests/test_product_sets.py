import itertools
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from packshot.operators.product_sets import product_sets

TYPES = ["Range", "Fridge", "Washer", "Oven"]


def frame(spark, bundles):
    texts = [(k, None if v is None else json.dumps([{"id": i, "productType": t} for i, t in v])) for k, v in bundles.items()]
    return spark.createDataFrame(texts, "line_key string, product_list_json string")


def expected(products, types=TYPES):
    """By definition: the first type of the layout varies fastest."""
    groups = [g for t in types if (g := [i for i, kind in products if kind == t])]
    return [list(reversed(c)) for c in itertools.product(*reversed(groups))]


def found(df):
    sets = {}
    for r in df.collect():
        key, number = r.img_id.rsplit("_", 1)
        assert key == r.line_key
        sets.setdefault(key, {})[int(number)] = r.sku_list
    assert all(sorted(s) == list(range(len(s))) for s in sets.values())
    return {k: [s[i] for i in range(len(s))] for k, s in sets.items()}


def test_worked_example(spark):
    bundle = [("f1", "Fridge"), ("w1", "Washer"), ("r1", "Range"), ("r2", "Range"), ("w2", "Washer"), ("w3", "Washer")]
    assert found(product_sets(frame(spark, {"b_1": bundle}), TYPES))["b_1"] == [
        ["r1", "f1", "w1"],
        ["r2", "f1", "w1"],
        ["r1", "f1", "w2"],
        ["r2", "f1", "w2"],
        ["r1", "f1", "w3"],
        ["r2", "f1", "w3"],
    ]


def test_edges(spark):
    bundles = {
        "empty": [],
        "stray": [("x", "Sofa")],
        "mixed": [("x", "Sofa"), ("r", "Range")],
        "twice": [("r", "Range"), ("r", "Range"), ("o", "Oven")],
        "unread": None,
    }
    assert found(product_sets(frame(spark, bundles), TYPES)) == {
        "empty": [[]],
        "stray": [[]],
        "mixed": [["r"]],
        "twice": [["r", "o"], ["r", "o"]],
    }


def test_types_run_parallel(spark):
    df = product_sets(frame(spark, {"k": [("o", "Oven"), ("r", "Range")]}), TYPES, with_types=True)
    assert df.select("sku_list", "type_list").first() == (["r", "o"], ["Range", "Oven"])


def test_layout_with_a_type_twice(spark):
    bundle = [("r1", "Range"), ("r2", "Range")]
    types = ["Range", "Oven", "Range"]
    assert found(product_sets(frame(spark, {"k": bundle}), types))["k"] == expected(bundle, types)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.text("abc", min_size=1, max_size=2), st.sampled_from([*TYPES, "Sofa"])), max_size=7), max_size=6))
def test_any_bundles(spark, lists):
    bundles = {f"b{i}": products for i, products in enumerate(lists)}
    want = {k: expected(v) for k, v in bundles.items()}
    assert found(product_sets(frame(spark, bundles), TYPES)) == want


def test_blocks_give_the_same_sets(spark):
    large = [(f"{t}{i}", t) for i in range(6) for t in TYPES]
    bundles = {"large": large, "small": large[:3], "empty": []}
    want = {k: expected(v) for k, v in bundles.items()}
    assert len(want["large"]) == 1296
    assert found(product_sets(frame(spark, bundles), TYPES, block=100)) == want


@pytest.mark.parametrize("name", ["3", "a-much-longer-identifier-that-makes-the-list-long"])
def test_a_repeated_type_multiplies_the_sets(spark, name):
    text = json.dumps([{"id": name, "productType": "A"}] * 17, separators=(",", ":"))
    lines = spark.createDataFrame([("k", text)], "line_key string, product_list_json string")
    assert product_sets(lines, ["A"] * 4).count() == 17**4


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(st.tuples(st.text("abc", min_size=1, max_size=2), st.sampled_from(TYPES)), max_size=5), max_size=5),
    st.lists(st.sampled_from(TYPES), min_size=1, max_size=4),
    st.integers(1, 9),
)
def test_any_layout_and_block(spark, lists, types, block):
    bundles = {f"b{i}": products for i, products in enumerate(lists)}
    assert found(product_sets(frame(spark, bundles), types, block=block)) == {k: expected(v, types) for k, v in bundles.items()}


def test_too_many_sets_raise(spark):
    types = [f"t{i}" for i in range(64)]
    bundle = [(f"{t}{i}", t) for t in types for i in range(2)]
    with pytest.raises(Exception, match="too many product sets: huge"):
        product_sets(frame(spark, {"huge": bundle}), types).limit(1).collect()


def test_no_layout(spark):
    with pytest.raises(ValueError, match="without product types"):
        product_sets(frame(spark, {"k": []}), [])


def test_strict(spark):
    good = {"k": [("r", "Range")]}
    assert found(product_sets(frame(spark, good), TYPES, strict=True)) == {"k": [["r"]]}
    with pytest.raises(Exception, match="not in layout: stray"):
        product_sets(frame(spark, {"stray": [("x", "Sofa")]}), TYPES, strict=True).collect()
    with pytest.raises(Exception, match="unreadable product list: none"):
        product_sets(frame(spark, {"none": None}), TYPES, strict=True).collect()
