"""Every registered query of the library against its SQL, over the whole small tables.

The training-data operators have no SQL; their own tests compare them with brute force.
"""

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from cohortflow.plans.landing import QUERIES
from cohortflow.plans.oracle import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")



@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return repr(float(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def counted(columns, table):
    order = [columns.index(c) for c in sorted(columns)]
    return Counter(tuple(plain(row[i]) for i in order) for row in table)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sql, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = sql.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(names)
    assert counted(result.columns, result.collect()) == counted(names, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 4
