import pytest
from pyspark.sql import functions as F

from packshot.operators.skew import find_hot, plan_by_output, salted_join, skew_join


@pytest.fixture(scope="module")
def sides(spark):
    left = [(1, i) for i in range(200)] + [(2, i) for i in range(40)] + [(k, 0) for k in range(3, 40)] + [(None, 1), (None, 2)]
    left += [(1, 7)] * 5
    right = [(k, f"r{k}{c}") for k in (1, 2, 3, 4, 99) for c in "ab"] + [(None, "n")]
    return spark.createDataFrame(left, "k int, v int"), spark.createDataFrame(right, "k int, w string")


def test_hot_keys_are_the_large_ones(sides, rows):
    hot = find_hot(sides[0], ["k"], share=10, rows=30)
    assert rows(hot) == [(1, 7), (2, 2)]
    assert find_hot(sides[0], ["k"]) is None
    # large in rows but not in share
    assert find_hot(sides[0], ["k"], share=1, rows=30) is None


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("tasks", [None, 3])
def test_same_as_a_plain_join(sides, rows, how, tasks):
    left, right = sides
    hot = find_hot(left, ["k"], share=10, rows=30)
    for found in (None, hot):
        joined = salted_join(left, right, ["k"], found, F.monotonically_increasing_id(), how, tasks)
        assert rows(joined) == rows(left.join(right, "k", how))
    assert rows(skew_join(left, right, ["k"], how, share=10, rows=30)) == rows(left.join(right, "k", how))


def test_hot_rows_are_spread(sides):
    left, right = sides
    hot = find_hot(left, ["k"], share=10, rows=30)
    joined = salted_join(left, right, ["k"], hot, F.monotonically_increasing_id(), tasks=16)
    places = joined.where("k = 1").select(F.spark_partition_id()).distinct().count()
    assert places > 3


def test_other_kinds_are_refused(sides):
    with pytest.raises(ValueError):
        salted_join(*sides, ["k"], None, F.lit(0), "outer")


def test_planned_by_output(sides, rows):
    left, right = sides
    hot, tasks = plan_by_output(left, right, ["k"], rows_per_task=50)
    # 205 * 2 + 40 * 2 + 2 + 2 rows
    assert tasks == 10
    assert rows(hot) == [(1, 3)]
    assert plan_by_output(left, right.where("k = 99"), ["k"]) == (None, 1)
    # no match, but as many tasks as the rows that are read need
    assert plan_by_output(left, right.where("k = 99"), ["k"], rows_per_task=50) == (None, 6)
