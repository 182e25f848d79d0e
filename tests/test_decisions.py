"""The decisions taken on the reference's contradictions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import star
from tessera.operators.history import OPEN_END


def d(day):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


OPEN = dt.datetime.fromisoformat(OPEN_END)


def dwh(spark, rows):
    return spark.createDataFrame(
        rows, "WKR long, truck_id string, WA_FROMDATE timestamp_ntz, WA_UNTODATE timestamp_ntz, WA_CRUD string, "
              "WA_CRUDDTS timestamp_ntz")


def test_x2_key_modes(spark):
    # two orders carry truck "a"; the conformed key is one per truck, as written is the latest order's root
    h = dwh(spark, [(10, "a", d(0), OPEN, "C", d(0)), (20, "a", d(5), OPEN, "C", d(5))])
    conf = star.dim_scd1(h, "truck_id", "WKR", "MK_TRUCK").collect()
    written = star.dim_scd1(h, "truck_id", "WKR", "MK_TRUCK", key_mode=star.AS_WRITTEN).collect()
    assert [r.MK_TRUCK for r in conf] == [10] and [r.MK_TRUCK for r in written] == [20]


def test_x7_change_date_with_and_without_deletes(spark):
    h = dwh(spark, [(10, "a", d(0), d(3), "C", d(0)), (10, "a", d(3), d(8), "U", d(3))])
    plain = star.dim_scd1(h, "truck_id", "WKR", "MK_TRUCK").first()
    counted = star.dim_scd1(h, "truck_id", "WKR", "MK_TRUCK", deletes_count=True).first()
    assert plain.MA_CHANGEDATE == d(3) and counted.MA_CHANGEDATE == d(8)
    assert plain.MA_ISDEL == 1


def test_x8_latest_row_ties_broken_by_root_key(spark):
    # one bulk load: equal WA_FROMDATE; the larger root key wins, deterministically
    h = dwh(spark, [(10, "a", d(0), OPEN, "C", d(0)), (30, "a", d(0), d(4), "C", d(0)),
                    (20, "a", d(0), OPEN, "C", d(0))])
    for _ in range(3):
        r = star.dim_scd1(h.repartition(3), "truck_id", "WKR", "MK_TRUCK", key_mode=star.AS_WRITTEN).first()
        assert r.MK_TRUCK == 30 and r.MA_ISDEL == 1


def test_x14_empty_string_ids_become_null(spark):
    df = spark.createDataFrame([("7",), ("",), (None,)], "discount_id string")
    got = [r[0] for r in df.select(F.expr("TRY_CAST(discount_id AS INT)")).collect()]
    assert got == [7, None, None]


def test_x9_weekend_flag_is_int_over_sunday_and_saturday(spark):
    hdr = spark.createDataFrame([(d(4), 1), (d(7), 1)], "order_ts timestamp_ntz, WA_ISCURR int")
    cal = {r.day_name: r.is_weekend for r in star.dim_date(hdr).collect()}
    assert cal == {"Friday": 0, "Saturday": 1, "Sunday": 1, "Monday": 0}
