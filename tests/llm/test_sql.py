import duckdb
import pytest

from ledgerlake.llm.queries import ORACLE, REGISTRY

from compare import spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    names, rows = spark_rows(REGISTRY[name](spark, SF_DIR))
    sql_names, expected = sql_rows(con, ORACLE[name])
    assert names == sql_names
    assert rows == expected
    assert sum(rows.values()) > 0
