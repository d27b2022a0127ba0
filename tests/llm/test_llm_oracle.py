"""Every corpus query that has a DuckDB answer, against it (sf0.001)."""

import os

import pytest

from daystream.llm.queries import ORACLE_SQL, QUERIES
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    assert rows_of(QUERIES[name](spark, SF).toPandas()) == rows_of(con.execute(ORACLE_SQL[name]).df())
