"""Staging loads under the control table."""

from __future__ import annotations

import os

import pytest

from tessera.sources import ingest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def need_tables():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")


def control(spark):
    return ingest.control_table(spark, [
        ("objectstore", SF, "events*.parquet", "staging", "stg_events", "parquet", True, "incremental"),
        ("objectstore", SF, "orders*.parquet", "staging", "stg_orders", "parquet", True, "full"),
        ("objectstore", SF, "part*.parquet", "staging", "stg_part", "parquet", False, "full"),
    ])


def test_incremental_rerun_adds_nothing_and_reset_starts_fresh(spark, tmp_path):
    row = ingest.select_loads(control(spark), "incremental").first()
    target, ck = str(tmp_path / "stg_events"), str(tmp_path / "ck")
    first = ingest.load_incremental(spark, row, target, ck, "r1", "2024-06-01 00:00:00")
    again = ingest.load_incremental(spark, row, target, ck, "r2", "2024-06-02 00:00:00")
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    assert (first.rows_before, first.rows_after, first.rows_written) == (0, n, n)
    assert (again.rows_before, again.rows_after, again.rows_written) == (n, n, 0)
    fresh = ingest.load_incremental(spark, row, target, ck, "r3", "2024-06-03 00:00:00", reset=True)
    assert fresh.path != target and (fresh.rows_before, fresh.rows_after) == (0, n)
    # the reset lasts: a plain run goes on in the new generation
    plain = ingest.load_incremental(spark, row, target, ck, "r4", "2024-06-04 00:00:00")
    assert (plain.path, plain.rows_before, plain.rows_written) == (fresh.path, n, 0)


def test_full_load_replaces_rows_and_admin_columns(spark, tmp_path):
    row = ingest.select_loads(control(spark), "full").first()
    target = str(tmp_path / "stg_orders")
    ingest.load_full(spark, row, target, "r1", "2024-06-01 00:00:00")
    res = ingest.load_full(spark, row, target, "r2", "2024-06-02 00:00:00")
    df = spark.read.parquet(target)
    assert res.rows_before == res.rows_after == df.count()
    assert {r.SA_RUNID for r in df.select("SA_RUNID").distinct().collect()} == {"r2"}


def test_modes_select_active_rows_and_unknown_type_stops(spark):
    c = control(spark)
    assert {r.target_table for r in ingest.select_loads(c, "both").collect()} == {"stg_events", "stg_orders"}
    assert [r.target_table for r in ingest.select_loads(c, "full").collect()] == ["stg_orders"]
    bad = c.unionByName(ingest.control_table(
        spark, [("x", SF, "x*", "staging", "stg_x", "parquet", True, "weekly")]))
    with pytest.raises(Exception, match="unknown load_type"):
        ingest.select_loads(bad, "both").collect()
    with pytest.raises(ValueError):
        ingest.select_loads(c, "hourly")


def test_source_without_declared_schema_may_grow(spark, tmp_path):
    src, target, ck = (str(tmp_path / x) for x in ("src", "stg_parts", "ck"))
    parts = spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", "p_brand", "p_size")
    parts.where("p_partkey < 50").drop("p_size").write.parquet(src)
    row = ingest.control_table(spark, [("o", src, "*.parquet", "staging", "stg_parts", "parquet", True, "incremental")]).first()
    ingest.load_incremental(spark, row, target, ck, "r1", "2024-06-01 00:00:00")
    parts.where("p_partkey >= 50").write.mode("append").parquet(src)
    ingest.load_incremental(spark, row, target, ck, "r2", "2024-06-02 00:00:00")
    got = ingest.read_target(spark, target)
    assert got.count() == parts.count() and got.where("p_size is null").count() == parts.where("p_partkey < 50").count()


def _narrow_then_wide(spark, src):
    """Two arrivals: the second has a wider key, a wider decimal, a wider struct field and one more column."""
    parts = spark.read.parquet(f"{SF}/part.parquet")
    early, late = parts.where("p_partkey < 50"), parts.where("p_partkey >= 50")
    early.selectExpr("cast(p_partkey as int) as p_partkey", "cast(p_size as decimal(6,1)) as price",
                     "struct(cast(p_size as int) as n) as box").coalesce(2).write.mode("append").parquet(src)
    yield
    late.selectExpr("cast(p_partkey as bigint) as P_PARTKEY", "cast(p_size as decimal(12,3)) as price",
                    "struct(cast(p_size as bigint) as n, p_brand as b) as box", "p_brand").write.mode("append").parquet(src)
    yield parts


def test_types_of_a_source_widen_and_the_log_keeps_them(spark, tmp_path):
    src, target, ck = (str(tmp_path / x) for x in ("src", "stg_parts", "ck"))
    row = ingest.control_table(spark, [("o", src, "*.parquet", "staging", "stg_parts", "parquet", True, "incremental")]).first()
    arrivals = _narrow_then_wide(spark, src)
    next(arrivals)
    first = ingest.load_incremental(spark, row, target, ck, "r1", "2024-06-01 00:00:00")
    assert first.schema["p_partkey"].dataType.simpleString() == "int"
    parts = next(arrivals)
    second = ingest.load_incremental(spark, row, target, ck, "r2", "2024-06-02 00:00:00")
    types = {f.name: f.dataType.simpleString() for f in second.schema}
    assert types["p_partkey"] == "bigint" and types["price"] == "decimal(12,3)"
    assert types["box"] == "struct<n:bigint,b:string>" and types["p_brand"] == "string"
    expect = sorted((r.p_partkey, r.p_size, r.p_size, r.p_brand if r.p_partkey >= 50 else None) for r in parts.collect())
    for got in (ingest.read_target(spark, target), ingest.read_target(spark, target, second.schema)):
        rows = got.selectExpr("p_partkey", "cast(price as int) as price", "cast(box.n as int) as n", "p_brand").collect()
        assert sorted(map(tuple, rows)) == expect


def test_unchanged_source_opens_no_old_footer(spark, tmp_path):
    """Seen files are spoiled in place (same length and time): a run that opened their footers would fail."""
    src, target, ck = (str(tmp_path / x) for x in ("src", "stg_parts", "ck"))
    row = ingest.control_table(spark, [("o", src, "*.parquet", "staging", "stg_parts", "parquet", True, "incremental")]).first()
    arrivals = _narrow_then_wide(spark, src)
    next(arrivals)
    first = ingest.load_incremental(spark, row, target, ck, "r1", "2024-06-01 00:00:00")
    for f in (tmp_path / "src").glob("*.parquet"):
        st = f.stat()
        f.write_bytes(b"x" * st.st_size)
        os.utime(f, ns=(st.st_atime_ns, st.st_mtime_ns))
    again = ingest.load_incremental(spark, row, target, ck, "r2", "2024-06-02 00:00:00")
    assert (again.rows_before, again.rows_written, again.schema) == (first.rows_after, 0, first.schema)
    assert not os.path.exists(f"{ck}_schemas/version=2")
    parts = next(arrivals)                      # new files next to the spoiled ones
    grown = ingest.load_incremental(spark, row, target, ck, "r3", "2024-06-03 00:00:00")
    assert grown.rows_after == parts.count() and grown.schema["p_partkey"].dataType.simpleString() == "bigint"


def test_log_without_commit_is_ignored_and_contradicting_types_stop(spark, tmp_path):
    from tessera.sources import schemalog
    src, log = str(tmp_path / "src"), str(tmp_path / "log")
    os.makedirs(src)
    assert schemalog.source_schema(spark, src, "*.parquet", log) is None
    spark.range(3).write.mode("append").parquet(src)
    schema = schemalog.source_schema(spark, src, "*.parquet", log)
    os.remove(f"{log}/version=1/_SUCCESS")
    assert schemalog.logged(spark, log)[1:] == (None, 0)
    assert schemalog.source_schema(spark, src, "*.parquet", log) == schema and os.path.exists(f"{log}/version=1/_SUCCESS")
    spark.createDataFrame([("a",)], "id string").write.mode("append").parquet(src)
    with pytest.raises(ValueError, match="'id' is bigint in earlier files and string"):
        schemalog.source_schema(spark, src, "*.parquet", log)
    assert not os.path.exists(f"{log}/version=2")


def test_source_without_files_loads_nothing(spark, tmp_path):
    src = str(tmp_path / "src")
    os.makedirs(src)
    row = ingest.control_table(spark, [("o", src, "*.parquet", "staging", "stg_none", "parquet", True, "incremental")]).first()
    got = ingest.load_incremental(spark, row, str(tmp_path / "t"), str(tmp_path / "ck"), "r1", "2024-06-01 00:00:00")
    assert (got.rows_before, got.rows_after, got.rows_written, got.schema) == (0, 0, 0, None)


def test_wider_types():
    from pyspark.sql import types as T
    from tessera.sources.schemalog import wider_type
    pairs = [("int", "bigint", "bigint"), ("smallint", "double", "double"), ("float", "double", "double"),
             ("bigint", "double", None), ("int", "float", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
             ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,2)", None),
             ("string", "int", None), ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,int>", "map<string,int>")]
    for a, b, want in pairs:
        for x, y in ((a, b), (b, a)):
            got = wider_type(T._parse_datatype_string(x), T._parse_datatype_string(y))
            assert (got and got.simpleString()) == want, (x, y)


def test_unreadable_target_is_an_error_not_empty(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.parquet").write_bytes(b"damaged")
    with pytest.raises(Exception):
        ingest._count(spark, str(tmp_path / "t"))
    assert ingest._count(spark, str(tmp_path / "none")) == 0


def test_control_seed_is_idempotent(spark):
    c = control(spark)
    twice = ingest.merge_control(ingest.merge_control(c, c), c)
    assert twice.count() == 3
