import os

import pytest

from ledgerlake.checks.oracle import ORACLE
from ledgerlake.checks.queries import REGISTRY

from compare import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert REGISTRY.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    names, rows = spark_rows(REGISTRY[name](spark, SF_DIR))
    sql_names, expected = sql_rows(con, ORACLE[name])
    assert names == sql_names
    assert rows == expected
    assert sum(rows.values()) > 0
