"""The registered queries: columns of their contracts, and DuckDB's rows where SQL can express them."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from medallion.llm import queries

sys.path.insert(0, os.path.join(os.path.dirname(E.__file__), "tools"))
from check_oracle import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_each_operator_has_its_query():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    found = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, rows, 6) == rows_of(columns, found.fetchall(), 6)
