"""Compare a DataFrame with the rows of a SQL query."""

from collections import Counter

import duckdb

TABLES = ("nation", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(row[i] for i in order) for row in rows)


def spark_rows(df):
    return _rows(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())
