"""Audit-log analysis: relative window, case-insensitive catalog match, top-n."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import audit

NOW = dt.datetime(2024, 6, 30)


def log(spark):
    rows = [(i, NOW - dt.timedelta(days=d), ("u@x",), "getTable",
             {"catalog_name": cat, "full_name_arg": f"{cat.lower()}.s.t"}, (200,), "10.0.0.1")
            for i, (d, cat) in enumerate([(1, "DEMO"), (5, "demo"), (40, "DEMO"), (2, "other"), (3, "Demo")])]
    return spark.createDataFrame(rows, "event_id int, event_time timestamp_ntz, user_identity struct<email:string>, "
                                       "action_name string, request_params map<string,string>, "
                                       "response struct<status_code:int>, source_ip_address string")


def test_recent_keeps_window_and_catalog_newest_first(spark):
    now = F.lit(NOW).cast("timestamp_ntz")
    got = [r.event_id for r in audit.audit_recent(log(spark), now, 30, "demo", n=2).collect()]
    assert got == [0, 4]
    everything = [r.event_id for r in audit.audit_recent(log(spark), now, 30, "DEMO", n=100).collect()]
    assert everything == [0, 4, 1]
