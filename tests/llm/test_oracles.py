"""Registered queries against their DuckDB SQL on the smallest given tables, whole."""

import os
import sys

import duckdb
import pytest
from tessera.llm.queries import ORACLE, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from check_oracle import digest  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows, want = [tuple(r) for r in df.collect()], duck.sql(ORACLE[name])
    expected = want.fetchall()
    assert sorted(df.columns) == sorted(want.columns) and len(rows) == len(expected)
    assert digest(df.columns, rows)[0] == digest(want.columns, expected)[0]
