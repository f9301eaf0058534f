"""Every registered query against its SQL on the smallest tables."""

import os
import re
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, same

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_of_bundles_has_sql():
    own = {n for n in entry.queries() if not n.startswith("op") and n != "pipeline"}
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_subpackage():
    code = "import sys; sys.modules['packshot.llm'] = sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()), *e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(entry.__file__), capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert "op6" not in done.stdout and int(done.stdout.split()[0]) > 40


def test_flagship(spark):
    found = entry.entry(spark)
    assert found.columns == ["line_key", "img_id", "sku_list"] and found.count() > 1000


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_same_as_sql(spark, db, name):
    verdict = same(entry.queries()[name](spark, SF_DIR).toPandas(), db.execute(entry.oracle_sql()[name]).df())
    assert verdict.startswith("ok"), verdict


def test_scans_read_what_they_need(spark):
    plan = entry.queries()["layer_skus"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    schemas = [set(re.findall(r"(\w+)#", x)) for x in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]
    order = {"l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"}
    assert {"l_orderkey", *order} in schemas and {"p_partkey", "p_type", "p_brand"} in schemas
    assert "Python" not in plan and "CartesianProduct" not in plan
