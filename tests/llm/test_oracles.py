"""Registered queries beside their SQL, where there is one."""

import duckdb
import pytest
from tablesync.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("conversations", "documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    mine = QUERIES[name](spark, SF_DIR)
    columns = ", ".join(f'"{c}"' for c in sorted(mine.columns))
    theirs = con.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, mine.select(*sorted(mine.columns)).collect())) == sorted(theirs)
