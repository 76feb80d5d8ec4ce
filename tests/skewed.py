"""The sample tables with a third of all lines in one online order, a third of
all lines on one product, and a third of all orders from one customer."""

from __future__ import annotations

import shutil
from pathlib import Path

import duckdb

SOURCE = "/root/testdata/sf0.001"
HOT_ORDER = """(SELECT min(o_orderkey) FROM orders WHERE o_orderkey % 10 < 3
               AND o_orderdate BETWEEN TIMESTAMP '1997-01-02' AND TIMESTAMP '1997-03-30')"""


def build(target: Path) -> str:
    for name in ("region", "nation", "customer", "supplier", "part"):
        shutil.copy(f"{SOURCE}/{name}.parquet", target / f"{name}.parquet")
    for name in ("events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"):
        shutil.copy(f"{SOURCE}/{name}.parquet", target / f"{name}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{SOURCE}/orders.parquet'")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SOURCE}/lineitem.parquet'")
    con.execute(f"""COPY (SELECT * REPLACE (
          CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM orders)
        TO '{target}/orders.parquet' (FORMAT parquet)""")
    con.execute(f"""COPY (SELECT DISTINCT ON (l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                              l_quantity, l_extendedprice) * FROM
          (SELECT * REPLACE (
            CASE WHEN hash(l_extendedprice) % 3 = 0 THEN {HOT_ORDER} ELSE l_orderkey END AS l_orderkey,
            CASE WHEN hash(l_suppkey, l_extendedprice) % 3 = 0 THEN 42 ELSE l_partkey END AS l_partkey)
           FROM lineitem))
        TO '{target}/lineitem.parquet' (FORMAT parquet)""")
    return str(target)
