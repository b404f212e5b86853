"""Every registered query on the smallest tables against its SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from comparison import connect, difference  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, tables, name):
    assert difference(QUERIES[name](spark, FOLDER), tables, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "id" and df.count() > 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
