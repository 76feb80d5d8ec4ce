"""Run registered queries next to their SQL and compare the results."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def oracle_connection(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows(columns: list[str], data) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in data]
    return [columns[i] for i in order], sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql: str):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return rows(columns, cursor.fetchall())


SPARK_TO_ORACLE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def oracle_types(con, sql: str) -> dict[str, str]:
    return {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}


def spark_types(df) -> dict[str, str]:
    return {name: SPARK_TO_ORACLE.get(kind, kind) for name, kind in df.dtypes}
