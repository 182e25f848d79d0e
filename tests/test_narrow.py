"""Narrow rows: what is shuffled is less, and every value comes back, odd ones too."""

from __future__ import annotations

import datetime as dt
import os
import time
from decimal import Decimal as D

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import narrow, star
from tessera.operators.keyed import range_lead
from tessera.operators.narrow import exchanged, narrow_columns
from tessera.operators.temporal import as_of_join
from tessera.session import cut_lineage

T0, T1 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
SCHEMA = "k long, t timestamp_ntz, u timestamp_ntz, z timestamp, a decimal(38,4), b decimal(38,0), c decimal(38,30), d decimal(10,2), s string"
BIG, LOW = (D(s + "9" * 34 + ".9999") for s in ("", "-"))
ROWS = [(1, T0, T0, T0, D("1.2345"), D(7), D("0.5"), D("2.50"), "x"), (1, T1, T0, T1, BIG, D(-7), None, None, None),
        (2, T0, None, None, None, D("9" * 38), D("1E-30"), D(0), ""), (None, None, T1, T0, LOW, None, None, None, "y"),
        (3, None, None, None, None, None, None, None, None), (2, T1, T1, T1, D("99999999999999.9999"), D(10 ** 18), None, D(1), "z")]


def test_every_value_comes_back(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for like in (None, "t", "k"):
        back = exchanged(df, lambda rows: rows.repartition(3, "k"), like, ["k"])
        assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
        assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    columns, _ = narrow_columns(df, "t")
    thin = df.select(*columns.values())
    assert thin.schema["a"].dataType.precision == 18 and thin.schema["c"].dataType.precision == 38
    first = thin.where("k = 1 and t = '2020-01-01'").first()
    assert first["u"] is None and first["_wide"] is None


def test_shuffles_of_lead_and_as_of_are_narrow(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).where("k is not null")
    lead = range_lead(df, ["k"], ["t"], "t", "ahead")
    joined = as_of_join(df, df.withColumn("e", F.timestamp_add("DAY", F.lit(9), "t")), ["k"], "t", "left", "t", "e")
    for frame in (lead, joined):
        assert "decimal(18,4)" in frame._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted(map(repr, lead.drop("ahead").collect())) == sorted(map(repr, df.collect()))
    assert sorted(map(repr, joined.select("l.*").collect())) == sorted(map(repr, df.collect()))
    found = [r for r in joined.collect() if r["r"] is not None]
    assert len(found) == 4 and all(tuple(r["l"]) == tuple(r["r"])[:-1] for r in found)


def test_line_fact_takes_header_keys_before_the_join(spark):
    """Large dimensions are looked up for versions, not for lines; unknown values have their key."""
    header = spark.createDataFrame(
        [(1, 1, 1, None, "E"), (2, 1, 2, 5, "E"), (3, 3, 2, 5, None)],
        "WK_ORDER_HEADER long, WKR_ORDER_HEADER long, order_id long, truck_id int, order_currency string") \
        .select("*", *(F.lit(None).cast(t).alias(c) for c, t in (
            ("location_id", "int"), ("customer_id", "long"), ("shift_id", "int"), ("order_channel", "string"), ("discount_id", "int"))),
            F.lit(T0).cast("timestamp_ntz").alias("WA_FROMDATE"), F.lit(T1).cast("timestamp_ntz").alias("WA_UNTODATE"),
            F.lit(T0).cast("timestamp_ntz").alias("order_ts"), F.lit(T1).cast("timestamp_ntz").alias("served_ts"))
    detail = spark.createDataFrame(
        [(i, i, i * 10, o, 7, 2, D("1.5"), D("3.0"), None, 1, T0, 1) for i, o in enumerate((1, 2, 2, 9), 1)],
        "WK_ORDER_DETAIL long, WKR_ORDER_DETAIL long, order_detail_id long, order_id long, menu_item_id long, quantity int, "
        "unit_price decimal(38,4), price decimal(38,4), order_item_discount_amount decimal(38,4), line_number int, order_ts timestamp_ntz, WA_ISCURR int")
    header = header.where("WK_ORDER_HEADER <> 2 or truck_id = 5").where("WK_ORDER_HEADER <> 3")
    fact = star.fct_sales_line(detail, header)
    left = star.fct_sales_line(detail, header, how="left")
    keys = ("order_id", "MK_TRUCK", "MK_CURRENCY", "MK_CUSTOMER", "MK_MENU_ITEM", "line_subtotal")
    want = [(1, 1, 1, 1, 1, D("3.0000")), (2, 1, 1, 1, 1, D("3.0000")), (2, 1, 1, 1, 1, D("3.0000"))]
    assert sorted(tuple(r) for r in fact.select(*keys).collect()) == want
    assert (9, 1, None) in [(r["order_id"], r["MK_TRUCK"], r["MK_CURRENCY"]) for r in left.collect()]
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    shuffled = plan[plan.index("Union"):]
    assert "MK_TRUCK" in shuffled and "MK_CUSTOMER" in shuffled


def test_latest_root_key_and_flag_come_with_the_rank(spark):
    """One aggregate, without a join, gives a dimension that carries no columns."""
    end = dt.datetime(9999, 12, 31)
    rows = [(-(1 << 63), "a", T0, T1, "C", T0), ((1 << 63) - 1, "a", T0, end, "U", T0), (5, "b", T1, T1, "U", T1), (6, "b", None, end, "C", T0),
            (None, "c", T0, T1, "C", T0), (0, None, dt.datetime(1, 1, 1), end, "C", T0), (0, "d", dt.datetime(1, 1, 1), T0, "C", T0)]
    dwh = spark.createDataFrame(rows, "WKR long, v string, WA_FROMDATE timestamp_ntz, WA_UNTODATE timestamp_ntz, WA_CRUD string, WA_CRUDDTS timestamp_ntz")
    dim = star.dim_scd1(dwh, "v", "WKR", "MK", key_mode=star.AS_WRITTEN)
    assert "Join" not in dim._jdf.queryExecution().optimizedPlan().toString()
    assert {r["v"]: (r["MK"], r["MA_ISDEL"]) for r in dim.collect()} == {
        "a": ((1 << 63) - 1, 0), "b": (5, 1), "c": (None, 1), None: (0, 0), "d": (0, 1)}


def _lines_and_versions(spark):
    header = spark.createDataFrame(
        [(1, 1, 1, 5, None, T0), (2, 1, 1, 5, 8, T1), (3, 3, 2, None, 8, T0), (4, 4, None, 6, 9, T0)],
        "WK_ORDER_HEADER long, WKR_ORDER_HEADER long, order_id long, truck_id int, customer_id long, WA_FROMDATE timestamp_ntz") \
        .select("*", *(F.lit(None).cast(t).alias(c) for c, t in (
            ("location_id", "int"), ("shift_id", "int"), ("order_channel", "string"), ("order_currency", "string"), ("discount_id", "int"))),
            F.lit(dt.datetime(9999, 1, 1)).cast("timestamp_ntz").alias("WA_UNTODATE"),
            F.lit(T0).cast("timestamp_ntz").alias("order_ts"), F.lit(T1).cast("timestamp_ntz").alias("served_ts"))
    header = header.withColumn("WA_UNTODATE", F.when(F.col("WK_ORDER_HEADER") == 1, F.lit(T1).cast("timestamp_ntz")).otherwise(F.col("WA_UNTODATE")))
    detail = spark.createDataFrame(
        [(1, 1, 10, 1, 7, 2, D("1.5"), BIG, None, 1, T0, 1), (2, 2, 10, 1, 7, 2, D("1.5"), BIG, None, 1, T0, 1), (3, 3, 20, 1, None, None, LOW, None, D("0.0001"), 2, T1, 1),
         (4, 4, 30, 2, 9, 1, D("2.25"), D("4"), D("1"), None, T1, 1), (5, 5, 40, 9, 7, 1, None, None, None, 1, T1, 1), (6, 6, 50, None, 7, 1, None, None, None, 1, T1, 1)],
        "WK_ORDER_DETAIL long, WKR_ORDER_DETAIL long, order_detail_id long, order_id long, menu_item_id long, quantity int, "
        "unit_price decimal(38,4), price decimal(38,4), order_item_discount_amount decimal(38,4), line_number int, order_ts timestamp_ntz, WA_ISCURR int")
    return detail, header


def test_large_dimensions_are_looked_up_narrow_from_stored_rows(spark):
    """With tables too large to broadcast, versions and joined lines are stored, so no shuffle stays beside the next; same rows."""
    detail, header = _lines_and_versions(spark)
    stored = []

    def store(rows, name):
        stored.append((name, rows))
        return cut_lineage(rows, name)

    def shuffled(src, attr, mk):
        return star.conformed_keys(detail if src == "detail" else header, attr, f"WKR_ORDER_{src.upper()}", mk)
    for how in ("inner", "left"):
        want = star.fct_sales_line(detail, header, how=how, store=store)
        assert not stored                               # small dimensions are broadcast: nothing more is written
        got = star.fct_sales_line(detail, header, how=how, lookup=shuffled, store=store)
        assert [n for n, _ in stored] == (["looked_up", "lookup_rows"] if how == "inner" else ["lookup_rows"] * 2)
        assert stored[-1][1].schema["price"].dataType.precision == 18
        assert got.schema == want.schema
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert got.count() == (4 if how == "inner" else 6)
        stored.clear()


def test_shuffles_behind_a_stored_table_are_removed(spark, monkeypatch):
    """Else they stay on disk until the driver collects its garbage, and a chain of tables holds them all at once."""
    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}
    monkeypatch.setattr(session, "RELEASE_BYTES", 0)
    before = shuffles()
    rows = spark.range(1000).repartition(3, "id").withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("id")))
    table = cut_lineage(rows, "released")
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert table.count() == 1000


def test_a_passing_table_is_dropped_alone(spark):
    kept, passing = cut_lineage(spark.range(5), "kept"), cut_lineage(spark.range(7), "passing")
    folder = passing.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    session.drop_table(passing)
    assert not os.path.exists(folder)
    assert kept.count() == 5
    assert session.release_tables(spark) >= 1


def test_packed_numbers_come_back(spark, monkeypatch):
    """Numbers of a large input share longs; NULLs, the ends of the types and rows outside a sample's range come back too."""
    monkeypatch.setattr(narrow, "PACK_BYTES", 0)
    top, low = (1 << 63) - 1, -(1 << 63)
    schema = "k long, i int, s short, b byte, g long, h long, p decimal(18,4), q decimal(38,4), r decimal(9,0), z decimal(18,18), n int, t timestamp_ntz"
    inside = [(i, i - 3, i, -i, 10 ** 9 + i, None if i % 3 else i, D(f"{i}.0{i}25"), D(i) / 4, D(-i), D(f"0.{i}"), None, T0) for i in range(8)]
    odd = [(None,) * 12, (9, (1 << 31) - 1, -(1 << 15), 127, top, low, D("99999999999999.9999"), BIG, D(999999999), D("0.999999999999999999"), 5, T1),
           (10, -(1 << 31), (1 << 15) - 1, -128, low, top, D("-99999999999999.9999"), LOW, D(-999999999), D("-0.999999999999999999"), None, None)]
    usual = spark.createDataFrame(inside, schema)
    for rows in (inside, inside + odd, odd):
        df = spark.createDataFrame(rows, schema)
        for fraction in (1.0, 0.5, 0.0):
            columns, whole = narrow.packed_columns(df, "t", ["k"], fraction=fraction)
            thin = df.select(*columns.values()).localCheckpoint()
            back = thin.select(*whole(lambda c: F.col(f"`{c}`")))
            assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
            assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    # ranges of the usual rows, then a row outside them: it travels loose
    monkeypatch.setattr(narrow, "_ranges", lambda thin, numbers, fraction, found=narrow._ranges: found(
        usual.select(*narrow.narrow_columns(usual, "t", ["k"])[0].values()), numbers, 1.0))
    df = spark.createDataFrame(inside + odd, schema)
    columns, whole = narrow.packed_columns(df, "t", ["k"])
    thin = df.select(*columns.values())
    assert not {"i", "g", "q"} & set(thin.columns) and len([c for c in thin.columns if c.startswith("_word")]) < 5
    assert thin.where("_loose is not null").count() == 2
    assert sorted(map(repr, thin.select(*whole(lambda c: F.col(f"`{c}`"))).collect())) == sorted(map(repr, df.collect()))


def test_lead_as_of_and_lookup_are_the_same_packed(spark, monkeypatch):
    detail, header = _lines_and_versions(spark)
    df = spark.createDataFrame(ROWS, SCHEMA).where("k is not null")

    def results():
        lead = range_lead(df.withColumn("m", F.col("k") * 3), ["k"], ["t", "m"], "t", "ahead")
        joined = as_of_join(df.withColumn("m", F.col("k") * 3), df.withColumn("e", F.timestamp_add("DAY", F.lit(9), "t")), ["k"], "t", "left", "t", "e")
        fact = star.fct_sales_line(detail, header, lookup=lambda src, attr, mk: star.conformed_keys(
            detail if src == "detail" else header, attr, f"WKR_ORDER_{src.upper()}", mk))
        return [(f.schema, sorted(map(repr, f.collect())), "_word" in f._jdf.queryExecution().optimizedPlan().toString()) for f in (lead, joined, fact)]
    plain = results()
    monkeypatch.setattr(narrow, "PACK_BYTES", 0)
    monkeypatch.setattr(narrow.packed_columns, "__defaults__", (None, (), (), 1.0))
    packed = results()
    assert [r[:2] for r in packed] == [r[:2] for r in plain]
    assert [r[2] for r in plain] == [False] * 3 and all(r[2] for r in packed)
