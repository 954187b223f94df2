"""Every registered query against its oracle, on whole tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as driver

ROOT = os.path.dirname(os.path.abspath(driver.__file__))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        con.execute(f"create view {file.split('.')[0]} as select * from '{SF_DIR}/{file}'")
    return con


def test_every_query_has_an_oracle():
    assert set(driver.QUERIES) == set(driver.ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_flagship(spark):
    assert driver.entry(spark).count() == 10


@pytest.mark.parametrize("name", driver.QUERIES)
def test_query(spark, duck, name):
    got = driver.queries()[name](spark, SF_DIR)
    want = duck.execute(driver.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in want.description}
    assert {column: TYPES[kind] for column, kind in got.dtypes} == types
    columns = sorted(types)
    order = [list(types).index(column) for column in columns]
    expected = sorted((tuple(row[i] for i in order) for row in want.fetchall()), key=repr)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == expected


def test_core_queries_without_an_optional_module():
    """Any module that only the queries for training data need may be missing."""
    code = (
        "import sys, warnings; sys.modules['zstandard'] = None; warnings.simplefilter('error', SyntaxWarning)\n"
        "import __spark_entry__ as entry; print(len(entry.queries()), sorted(entry.queries()) == sorted(entry.QUERIES))"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert done.stdout.split() == [str(len(driver.QUERIES)), "True"]
    assert "zstandard" in done.stderr or not os.path.isdir(os.path.join(ROOT, "layerstats", "llm"))
