"""Rule tagging and routing; table changes and change feeds."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import changes, quality
from tessera.operators.entity import DROP, WARN, Entity, Rule

RULES = (Rule("a_not_null", "a IS NULL"), Rule("b_non_negative", "b < 0"), Rule("b_small", "b > 100", WARN))
E = Entity(name="t", keys=("k",), columns=(("k", "k"), ("a", "a"), ("b", "b")), hash_columns=("a", "b"),
           rules=RULES)


def staged(spark, data):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(k, a, b, t, "insert", t, "s", "r") for k, a, b in data],
                                 "k long, a string, b int, _commit_timestamp timestamp_ntz, _change_type string, "
                                 "SA_CRUDDTS timestamp_ntz, SA_SRC string, SA_RUNID string")


def test_failed_rules_forms_agree_and_null_passes_range_rule(spark):
    df = staged(spark, [(1, "x", 5), (2, None, -1), (3, None, None), (4, "y", None)])
    drops = E.rules_of(DROP)
    got = df.select("k", quality.failed_rules(drops).alias("f1"),
                    quality.failed_rules_except(drops).alias("f2")).orderBy("k").collect()
    assert [r.f1 for r in got] == [[], ["a_not_null", "b_non_negative"], ["a_not_null"], []]
    assert [sorted(r.f1) for r in got] == [sorted(r.f2) for r in got]


def test_clean_plus_quarantine_is_input_and_counts(spark):
    tagged = quality.tag(staged(spark, [(1, "x", 5), (2, None, -1), (3, None, 1), (4, "z", 500)]), E)
    assert quality.clean(tagged).count() + quality.quarantine(tagged, E).count() == 4
    assert {r.rule: r.violations for r in quality.rule_counts(tagged, E).collect()} == \
        {"a_not_null": 2, "b_non_negative": 1}
    assert {r.rule: r.violations for r in quality.warn_counts(tagged, E).collect()} == {"b_small": 1}
    assert [r.k for r in quality.triage(quality.quarantine(tagged, E), "b_non_negative").collect()] == [2]
    assert "failed_rules" not in quality.clean(tagged).columns


def test_counts_come_from_the_write_that_stores_the_rows(spark):
    tagged = quality.tag(staged(spark, [(1, "x", 5), (2, None, -1), (3, None, 1), (4, "z", 500)]), E)
    table, counts = quality.store_tagged(tagged, E, "t")
    assert sorted(table.collect(), key=lambda r: r.k) == sorted(tagged.collect(), key=lambda r: r.k)
    assert {(r.entity, r.rule, r.severity, r.input_rows, r.violations) for r in counts.collect()} == {
        ("t", "a_not_null", "drop", 4, 2), ("t", "b_non_negative", "drop", 4, 1), ("t", "b_small", "warn", 4, 1)}
    _, none = quality.store_tagged(tagged.where("k > 9"), E, "t")
    assert {(r.input_rows, r.violations) for r in none.collect()} == {(0, 0)}


def test_hash_treats_null_and_empty_alike(spark):
    tagged = quality.tag(staged(spark, [(1, None, 5), (2, "", 5)]), E).orderBy("k").collect()
    assert tagged[0].WA_HASH == tagged[1].WA_HASH and len(tagged[0].WA_HASH) == 64


def test_require_stops_the_run(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    with pytest.raises(Exception, match="key missing"):
        quality.require(df, "k IS NOT NULL", "key missing").collect()
    assert quality.require(df.where("k = 1"), "k IS NOT NULL", "key missing").count() == 1


def snap(spark, data):
    return spark.createDataFrame(data, "k int, v string")


def test_snapshot_diff_emits_insert_delete_and_update_pairs(spark):
    old = snap(spark, [(1, "a"), (2, "b"), (3, "c")])
    new = snap(spark, [(1, "a"), (2, "B"), (4, "d")])
    d = changes.snapshot_diff(old, new, ["k"], 7, F.lit("2024-01-01").cast("timestamp_ntz"))
    got = sorted((r.k, r.v, r._change_type, r._commit_version) for r in d.collect())
    assert got == [(2, "B", "update_postimage", 7), (2, "b", "update_preimage", 7), (3, "c", "delete", 7),
                   (4, "d", "insert", 7)]


def test_as_of_version_replays_feed(spark):
    feed = spark.createDataFrame(
        [(1, "a", 0, "insert"), (2, "b", 0, "insert"), (1, "a2", 1, "update_postimage"), (1, "a", 1, "update_preimage"),
         (2, None, 2, "delete")],
        "k int, v string, _commit_version long, _change_type string") \
        .withColumn("_commit_timestamp", F.timestamp_seconds(F.col("_commit_version") * 86400).cast("timestamp_ntz"))
    at0 = sorted((r.k, r.v) for r in changes.as_of(feed, ["k"], version=0).collect())
    at2 = sorted((r.k, r.v) for r in changes.as_of(feed, ["k"], version=2).collect())
    at_ts = sorted((r.k, r.v) for r in changes.as_of(feed, ["k"], ts="1970-01-02 00:00:00").collect())
    assert at0 == [(1, "a"), (2, "b")] and at2 == [(1, "a2")] and at_ts == [(1, "a2"), (2, "b")]
    h = changes.version_history(feed).orderBy("_commit_version").collect()
    assert [(r.inserted, r.updated, r.deleted) for r in h] == [(2, 0, 0), (0, 1, 0), (0, 0, 1)]
    assert [r.is_previous for r in h] == [False, True, False] and h[0].is_earliest


def test_merge_insert_only_is_idempotent(spark):
    target = snap(spark, [(1, "a")])
    seed = snap(spark, [(1, "x"), (2, "b")])
    once = changes.merge_insert_only(target, seed, ["k"])
    twice = changes.merge_insert_only(once, seed, ["k"])
    assert sorted(map(tuple, twice.collect())) == [(1, "a"), (2, "b")]


def test_update_and_delete_where_keep_null_condition_rows(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "k int, b int")
    up = changes.update_where(df, "b > 15", {"b": F.lit(0)})
    assert sorted(map(tuple, up.collect()), key=repr) == sorted([(1, 10), (2, None), (3, 0)], key=repr)
    de = changes.delete_where(df, "b > 15")
    assert sorted(r.k for r in de.collect()) == [1, 2]


def test_reconcile_classifies_keys(spark):
    s = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h3")], "k int, WA_HASH string")
    t = spark.createDataFrame([(1, "h1"), (2, "zz"), (4, "h4")], "k int, WA_HASH string")
    got = dict(map(tuple, changes.reconcile(s, t, ["k"]).collect()))
    assert got == {1: "match", 2: "mismatch", 3: "missing_in_target", 4: "missing_in_source"}


def test_cdc_adapter_maps_operation_codes(spark):
    cdc = spark.createDataFrame([(1, "I", 10, dt.datetime(2024, 1, 1)), (1, "d", 11, dt.datetime(2024, 1, 2))],
                                "k int, op string, lsn long, op_ts timestamp_ntz")
    got = [(r._change_type, r._commit_version)
           for r in changes.cdc_adapter(cdc).orderBy("_commit_version").collect()]
    assert got == [("insert", 10), ("delete", 11)]


def test_snapshot_diff_compares_values(spark):
    """NULL against an empty string, and a separator inside a value, are changes."""
    old = spark.createDataFrame([(1, None, "x"), (2, "a||b", "c"), (3, "s", None), (4, None, None)], "k int, v string, w string")
    new = spark.createDataFrame([(1, "", "x"), (2, "a", "b||c"), (3, "s", None), (4, None, None)], "k int, v string, w string")
    d = changes.snapshot_diff(old, new, ["k"], 1, F.lit("2024-01-01").cast("timestamp_ntz")).collect()
    assert sorted((r.k, r.v, r.w, r._change_type) for r in d if r._change_type == "update_postimage") == \
        [(1, "", "x", "update_postimage"), (2, "a", "b||c", "update_postimage")]


def test_version_history_picks(spark):
    rows = [(v, dt.datetime(2024, 1, v + 1), "insert") for v in (0, 0, 1, 3)]
    h = changes.version_history(spark.createDataFrame(rows, "_commit_version long, _commit_timestamp timestamp_ntz, _change_type string"))
    assert sorted((r._commit_version, r.is_previous, r.is_earliest) for r in h.collect()) == \
        [(0, False, True), (1, True, False), (3, False, False)]
    one = changes.version_history(spark.createDataFrame(rows[:1], "_commit_version long, _commit_timestamp timestamp_ntz, _change_type string"))
    assert [(r.is_previous, r.is_earliest) for r in one.collect()] == [(False, True)]


def test_hash_is_stored_only_where_the_typed_columns_do_not_give_it(spark):
    from tessera.operators import history
    typed = Entity(name="t", keys=("k",), columns=(("k", "k"), ("a", "TRY_CAST(a AS INT)"), ("b", "b")), hash_columns=("a", "b"))
    other = Entity(name="t", keys=("k",), columns=(("k", "k"), ("b", "b")), hash_columns=("a", "b"))     # a is not typed
    feed = staged(spark, [(1, "7", 5), (2, "07", 5), (3, None, None), (4, "x", 1), (5, "", 2)])
    for e, kept in ((typed, [2, 4]), (other, [1, 2, 3, 4, 5])):
        tagged = quality.tag(feed, e)
        whole = {r.k: r.WA_HASH for r in tagged.collect()}
        spare = tagged.withColumn("WA_HASH", quality.spare_hash(e))
        assert sorted(r.k for r in spare.where("WA_HASH IS NOT NULL").collect()) == kept
        assert {r.k: r.WA_HASH for r in spare.withColumn("WA_HASH", quality.whole_hash(e)).collect()} == whole
        table, _ = quality.store_tagged(tagged, e, "t")
        assert {r.k: r.WA_HASH for r in table.collect()} == whole
        assert {r.k: r.WA_HASH for r in history.scd2(quality.clean(table), e, hashed=True).collect()} == whole


def test_header_hash_comes_back_from_typed_columns(spark):
    from tessera.plans.entities import HEADER
    from tessera.sources.fixtures import chg_order_header
    orders = spark.createDataFrame(
        [(k, k * 3, "O", 12.34 * k, dt.datetime(1995, 1, k % 28 + 1), "1-URGENT") for k in range(1, 60)] + [(61, None, "F", None, None, None)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    import tempfile
    with tempfile.TemporaryDirectory() as d:
        orders.write.parquet(f"{d}/orders.parquet")
        tagged = quality.tag(chg_order_header(spark, d), HEADER)
        spare = tagged.withColumn("WA_HASH", quality.spare_hash(HEADER))
        assert spare.where("WA_HASH IS NOT NULL AND order_id < 60").count() == 0
        whole = spare.withColumn("WA_HASH", quality.whole_hash(HEADER))
        assert sorted(map(str, whole.collect())) == sorted(map(str, tagged.collect()))
