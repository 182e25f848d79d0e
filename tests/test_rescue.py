"""Input that does not fit the declared schema: values are rescued, rows stay."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from tessera.sources import ingest
from tessera.sources.rescue import RESCUED, file_layouts, rescue_json, scan_rescued

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("amount", T.DoubleType()),
                       T.StructField("day", T.DateType()), T.StructField("tags", T.ArrayType(T.StringType()))])


def files(spark, path):
    return ingest._glob(spark, f"{path}/*.parquet")


def rescued(rows):
    """id to (row without what is rescued, what is rescued without the file)."""
    out = {}
    for r in rows:
        extra = json.loads(r[RESCUED]) if r[RESCUED] else None
        if extra:
            assert extra.pop("_file_path", "x").startswith(("file:", "x"))
        out.setdefault(r["id"], []).append((r["amount"], r["day"], r["tags"], extra))
    return out


def test_types_that_differ_are_cast_or_rescued(spark, tmp_path):
    path = str(tmp_path / "drop")
    spark.createDataFrame([(1, 1.5, dt.date(2024, 1, 2), ["a"]), (2, None, None, None)], SCHEMA).write.parquet(path)
    spark.createDataFrame([("3", "2.5", "2024-01-03", "t"), ("x4", "n/a", None, None), ("5", "1e2", "soon", None)],
                          "ID string, amount string, day string, tags string").write.mode("append").parquet(path)
    spark.createDataFrame([(6, 7, dt.datetime(2024, 1, 2), "n"), (1 << 40, None, dt.datetime(2024, 1, 2, 3), None)],
                          "id long, amount int, day timestamp_ntz, `no te` string").write.mode("append").parquet(path)
    got = rescued(scan_rescued(spark, files(spark, path), SCHEMA).collect())
    assert got[1] == [(1.5, dt.date(2024, 1, 2), ["a"], None)] and got[2] == [(None, None, None, None)]
    assert got[3] == [(2.5, dt.date(2024, 1, 3), None, {"tags": "t"})]
    assert got[5] == [(100.0, None, None, {"day": "soon"})]
    assert got[6] == [(7.0, dt.date(2024, 1, 2), None, {"no te": "n"})]
    by_first = {min(g[3]): g for g in got[None]}                # ids that don't fit
    assert by_first["amount"] == (None, None, None, {"id": "x4", "amount": "n/a"})
    assert by_first["day"][3]["id"] == 1 << 40 and by_first["day"][3]["day"].startswith("2024-01-02T03")
    assert sum(map(len, got.values())) == 7


def test_unreadable_files_are_named_and_no_file_is_empty(spark, tmp_path):
    path = tmp_path / "drop"
    spark.createDataFrame([(1, 1.5, None, None)], SCHEMA).coalesce(1).write.parquet(str(path))
    (path / "broken.parquet").write_bytes(b"not a table")
    rows = scan_rescued(spark, files(spark, str(path)), SCHEMA).collect()
    assert len(rows) == 2
    lost = next(r for r in rows if r["id"] is None)
    assert json.loads(lost[RESCUED])["_corrupt_file"].endswith("broken.parquet")
    empty = scan_rescued(spark, [], SCHEMA)
    assert empty.columns == [*SCHEMA.names, RESCUED] and empty.count() == 0


def test_failures_other_than_layout_are_raised(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_rescued(spark, [str(tmp_path / "gone.parquet")], SCHEMA)


def test_one_scan_per_layout_and_pushdown_where_types_fit(spark, tmp_path):
    path = str(tmp_path / "drop")
    fits = spark.createDataFrame([(i, 1.0, None, None) for i in range(9)], SCHEMA).repartition(3)
    text = spark.createDataFrame([("1",)] * 9, "id string").repartition(3)
    for part in (fits, text, fits, text):
        part.write.mode("append").parquet(path)
    layouts, unreadable = file_layouts(spark, files(spark, path))
    assert not unreadable and len(layouts) == 2 and sum(len(p) for _, p in layouts) == len(files(spark, path))
    plan = scan_rescued(spark, layouts[0][1] + layouts[1][1], SCHEMA).where("id = 3") \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "EqualTo(id,3)" in plan


def test_load_rescued_stages_each_file_once(spark, tmp_path):
    path, target, ck = (str(tmp_path / d) for d in ("drop", "target", "ck"))
    row = ingest.control_table(spark, [("erp", path, "*.parquet", "staging", "t", "parquet", True, "incremental")]).first()
    spark.createDataFrame([(1, 1.5, None, None)], SCHEMA).write.parquet(path)
    first = ingest.load_rescued(spark, row, target, ck, "r1", "2024-06-01 00:00:00", SCHEMA)
    again = ingest.load_rescued(spark, row, target, ck, "r2", "2024-06-01 00:00:00", SCHEMA)
    spark.createDataFrame([("a",), ("2",)], "id string").write.mode("append").parquet(path)
    last = ingest.load_rescued(spark, row, target, ck, "r3", "2024-06-01 00:00:00", SCHEMA)
    assert [(r.rows_before, r.rows_written, r.rows_after) for r in (first, again, last)] == [(0, 1, 1), (1, 0, 1), (1, 2, 3)]
    staged = ingest.read_target(spark, target)
    assert sorted((r["id"] or 0, r["SA_RUNID"], r[RESCUED] is not None) for r in staged.collect()) == \
        [(0, "r3", True), (1, "r1", False), (2, "r3", False)]


def test_json_records(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("at", T.DateType()),
                           T.StructField("in", T.StructType([T.StructField("q", T.LongType())]))])
    texts = ['{"k": 1, "at": "2024-02-03", "in": {"q": 5}}', '{"k": "x", "more": [1, 2]}', '{"k', "[1]", "", None,
             '{"k": null}', '{"k": 1.5}', '{"in": "text"}', '{"in": {"q": "y", "r": 1}}']
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "n int, k string, _rescued_data string")
    out = rescue_json(df, "k", schema)
    assert out.columns == ["n", "k", "at", "in", RESCUED]
    got = {r["n"]: r for r in out.collect()}
    assert (got[0]["k"], got[0]["at"], got[0]["in"]["q"], got[0][RESCUED]) == (1, dt.date(2024, 2, 3), 5, None)
    assert json.loads(got[1][RESCUED]) == {"k": "x", "more": "[1,2]"} and got[1]["k"] is None
    assert json.loads(got[2][RESCUED]) == {"_corrupt_record": '{"k'} and json.loads(got[3][RESCUED]) == {"_corrupt_record": "[1]"}
    assert [got[i][RESCUED] for i in (4, 5, 6)] == [None] * 3
    assert json.loads(got[7][RESCUED]) == {"k": "1.5"}
    assert json.loads(got[8][RESCUED]) == {"in": "text"}
    assert json.loads(json.loads(got[9][RESCUED])["in"]) == {"q": "y", "r": 1}
