"""The driver's correctness gate in miniature: registered queries against their
DuckDB oracle SQL on the smallest given tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import digest  # noqa: E402
from tessera.sources.tables import TABLES, table_path  # noqa: E402

SF = "/root/testdata/sf0.001"
SAMPLE = ["monthly_revenue_by_currency", "scd2_header", "dwh_detail", "sales_line", "fct_temporal_left",
          "rule_counts", "dim_truck", "dim_date", "snapshot_diff", "as_of_version", "hash_reconcile",
          "lineage_downstream", "audit_summary", "scd2_tracked", "inline_rows"]


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() >= 0


def test_every_query_has_an_oracle():
    from tessera.plans.oracle import ORACLE
    from tessera.plans.registry import QUERIES
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.sql(entry.oracle_sql()[name])
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(res.columns)
    assert len(srows) == len(orows)
    assert digest(sdf.columns, srows)[0] == digest(res.columns, orows)[0]
