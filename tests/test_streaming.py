"""Streaming history equals batch history, whatever the arrival order."""

from __future__ import annotations

import datetime as dt

import pytest

from tessera.operators import history, quality
from tessera.operators.entity import FAIL, Entity, Rule
from tessera.streaming import state
from tessera.streaming.pipelines import run_history_stream

E = Entity(name="acct", keys=("k",), columns=(("k", "k"), ("v", "v")), hash_columns=("v",),
           rules=(Rule("v_non_negative", "v < 0"), Rule("k_not_null", "k IS NULL", FAIL)))
SCHEMA = ("k long, v int, _commit_timestamp timestamp_ntz, _change_type string, SA_CRUDDTS timestamp_ntz, "
          "SA_SRC string, SA_RUNID string")


def ts(day):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def change(k, v, day, kind):
    return (k, v, ts(day), kind, ts(day), "s", "r")


# three arrivals; the last one carries a change older than a delete already stored
ARRIVALS = [
    [change(1, 10, 0, "insert"), change(2, 20, 0, "insert"), change(3, 30, 1, "insert")],
    [change(1, 11, 5, "update_postimage"), change(2, None, 6, "delete"), change(3, -1, 7, "update_postimage")],
    [change(2, 21, 3, "update_postimage"), change(1, 12, 2, "update_postimage"), change(4, 40, 9, "insert")],
]


def _write_arrivals(spark, root):
    for i, rows in enumerate(ARRIVALS):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/feed/part{i}")


def _stream(spark, root):
    from pyspark.sql import types as T
    schema = T._parse_datatype_string(SCHEMA)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1") \
        .option("recursiveFileLookup", "true").parquet(f"{root}/feed")


def _batch(spark):
    return quality.clean(quality.tag(spark.createDataFrame([r for a in ARRIVALS for r in a], SCHEMA), E))


def test_scd2_stream_equals_batch(spark, tmp_path):
    root = str(tmp_path)
    _write_arrivals(spark, root)
    got = run_history_stream(_stream(spark, root), E, 2, f"{root}/store", f"{root}/ck", buckets=4).history
    cols = ["k", "v", "__START_AT", "__END_AT"]
    expect = sorted(map(tuple, history.scd2(_batch(spark), E).select(cols).collect()), key=repr)
    assert sorted(map(tuple, got.select(cols).collect()), key=repr) == expect
    wk = [r[0] for r in got.select("WK_ACCT").collect()]
    assert len(wk) == len(set(wk)) == len(expect)
    # the late change of key 2 lands before its stored delete: it closes at the delete, no reopening
    assert [(r["v"], r["__END_AT"]) for r in got.where("k = 2").orderBy("__START_AT").collect()] == \
        [(20, ts(3)), (21, ts(6))]


def test_scd1_stream_equals_batch(spark, tmp_path):
    root = str(tmp_path)
    _write_arrivals(spark, root)
    got = run_history_stream(_stream(spark, root), E, 1, f"{root}/store", f"{root}/ck", buckets=4).history
    expect = sorted((r.k, r.v) for r in history.scd1(_batch(spark), E).collect())
    assert sorted((r.k, r.v) for r in got.collect()) == expect == [(1, 11), (3, 30), (4, 40)]


def test_stream_rerun_adds_nothing(spark, tmp_path):
    root = str(tmp_path)
    _write_arrivals(spark, root)
    args = (E, 2, f"{root}/store", f"{root}/ck")
    first = run_history_stream(_stream(spark, root), *args, buckets=4).history.collect()
    again = run_history_stream(_stream(spark, root), *args, buckets=7).history.collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_every_row_goes_to_history_or_quarantine(spark, tmp_path):
    root = str(tmp_path)
    _write_arrivals(spark, root)
    out = run_history_stream(_stream(spark, root), E, 2, f"{root}/store", f"{root}/ck", buckets=4)
    stored = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/store/buckets=4/runs").where("NOT _root").dropDuplicates(["k", "__START_AT"])
    assert stored.count() + out.quarantine.count() == sum(len(a) for a in ARRIVALS)
    assert [(r.k, r.failed_rules) for r in out.quarantine.collect()] == [(3, ["v_non_negative"])]
    counts = out.rule_counts.collect()
    assert len({r.batch for r in counts}) == len(ARRIVALS)
    assert {r: sum(c.violations for c in counts if c.rule == r) for r in ("v_non_negative", "k_not_null")} == \
        {"v_non_negative": 1, "k_not_null": 0}
    assert sum(c.input_rows for c in counts if c.rule == "k_not_null") == sum(len(a) for a in ARRIVALS)


def test_history_view_of_streamed_history_follows_start_order(spark, tmp_path):
    root = str(tmp_path)
    _write_arrivals(spark, root)
    dw = run_history_stream(_stream(spark, root), E, 2, f"{root}/store", f"{root}/ck", buckets=4).history
    for hot in ({}, {"hot_rows": 1, "chunk_rows": 1, "fraction": 1.0}):
        rows = history.history_view(dw, E, **hot).orderBy("k", "WA_FROMDATE").collect()
        for k in (1, 2, 3, 4):
            mine = [r for r in rows if r.k == k]
            assert [r.WKP_ACCT for r in mine] == [None, *(r.WK_ACCT for r in mine[:-1])]
            assert {r.WKR_ACCT for r in mine} == {mine[0].WK_ACCT}


def test_broken_fail_rule_stops_the_stream_and_leaves_no_trace(spark, tmp_path):
    root = str(tmp_path)
    good, bad = [change(1, 10, 0, "insert")], [change(2, 5, 1, "insert"), change(None, 7, 2, "insert")]
    spark.createDataFrame(good, SCHEMA).coalesce(1).write.parquet(f"{root}/feed/part0")
    run_history_stream(_stream(spark, root), E, 2, f"{root}/store", f"{root}/ck", buckets=4)
    spark.createDataFrame(bad, SCHEMA).coalesce(1).write.parquet(f"{root}/feed/part1")
    with pytest.raises(Exception, match="k_not_null"):
        run_history_stream(_stream(spark, root), E, 2, f"{root}/store", f"{root}/ck", buckets=4)
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/store/buckets=4/runs").where("NOT _root").count() == 1
    # the corrected file takes the bad one's place
    import glob
    import os
    name = glob.glob(f"{root}/feed/part1/*.parquet")[0]
    fixed = spark.createDataFrame([change(2, 5, 1, "insert"), change(3, 7, 2, "insert")], SCHEMA).coalesce(1)
    fixed.write.parquet(f"{root}/fixed")
    os.replace(glob.glob(f"{root}/fixed/*.parquet")[0], name)
    for crc in glob.glob(f"{root}/feed/part1/.*.crc"):
        os.remove(crc)
    out = run_history_stream(_stream(spark, root), E, 2, f"{root}/store", f"{root}/ck", buckets=4)
    assert sorted((r.k, r.v) for r in out.history.collect()) == [(1, 10), (2, 5), (3, 7)]
    assert sum(c.input_rows for c in out.rule_counts.where("rule = 'k_not_null'").collect()) == 3


def _changes(spark, rows):
    """Clean changes (key, value, day, kind) as the store takes them."""
    return quality.clean(quality.tag(spark.createDataFrame([change(*r) for r in rows], SCHEMA), E)) \
        .select("k", "v", "WA_CRUD", "_commit_timestamp")


def _store(spark, path, buckets=3):
    from tessera.streaming.state import SpliceStore
    return SpliceStore.open(spark, str(path), E, buckets)


def _versions(spark, store):
    empty = spark.createDataFrame([], "k long, v int, __START_AT timestamp_ntz, __END_AT timestamp_ntz")
    return sorted(map(tuple, store.versions(empty).collect()), key=repr)


def _expected(rows):
    """Versions by key from plain lists: the last arrival of one key and day counts."""
    latest = {}
    for k, v, day, kind in rows:
        latest[k, day] = (v, kind)
    out = []
    for (k, day), (v, kind) in latest.items():
        later = [d for (kk, d) in latest if kk == k and d > day]
        if kind != "delete":
            out.append((k, v, ts(day), ts(min(later)) if later else None))
    return sorted(out, key=repr)


def _batches(n, per_batch=12, keys=9, seed=3):
    """Mostly on time, some late, some deletes, one hot key; new keys turn up all the time."""
    import random
    rng = random.Random(seed)
    out = []
    for i in range(n):
        rows = []
        for _ in range(per_batch):
            day = i * 10 + rng.randint(0, 9) if rng.random() < 0.8 else rng.randint(0, i * 10 + 9)
            k = 1 if rng.random() < 0.3 else rng.randint(2, keys + i)
            rows.append((k, rng.randint(0, 99), day, "delete" if rng.random() < 0.2 else "insert"))
        out.append(list({(r[0], r[2]): r for r in rows}.values()))
    return out


@pytest.mark.parametrize("hot", [{}, {"hot_rows": 1, "chunk_rows": 1, "fraction": 1.0}])
def test_spliced_history_equals_history_of_all_changes(spark, tmp_path, hot):
    store, seen = _store(spark, tmp_path / "s"), []
    current = {}
    for i, rows in enumerate(_batches(4, per_batch=20)):
        delta = store.apply(_changes(spark, rows), i, deltas=True, **hot)
        for r in sorted(delta.collect(), key=lambda r: r["_sign"]):
            (current.pop((r["k"], r["__START_AT"])) if r["_sign"] < 0 else current.update({(r["k"], r["__START_AT"]): r["v"]}))
        seen += rows
        assert _versions(spark, store) == _expected(seen)
        assert sorted((k, v, a, None) for (k, a), v in current.items()) == sorted(x for x in _expected(seen) if x[3] is None)


def test_replayed_batch_and_merged_runs(spark, tmp_path):
    store, seen = _store(spark, tmp_path / "s"), []
    for i, rows in enumerate(_batches(9, per_batch=5)):
        store.apply(_changes(spark, rows), i)
        if i in (3, 4, 8):                                      # before and after a merge
            store.apply(_changes(spark, rows), i)
        seen += rows
    assert store.runs() == [(0, 3), (4, 7), (8, 8)]
    assert _versions(spark, store) == _expected(seen)
    assert _store(spark, tmp_path / "s", 7).buckets == 3


def test_a_batch_reads_the_intervals_around_its_changes(spark, tmp_path):
    """Each batch changes the same keys: what it finds near is one open interval per key and run, however long the history."""
    store, found = _store(spark, tmp_path / "s"), []
    near = store.near
    store.near = lambda *a: found.append(near(*a)) or found[-1]
    reads = []
    for i in range(9):
        rows = [(k, i, i * 10, "insert") for k in range(40)] + ([(3, i, 5, "insert")] if i == 6 else [])
        store.apply(_changes(spark, rows), i)
        reads.append(found[-1].count())
    assert reads[:6] == [0, 40, 80, 120, 40, 80] and 120 < reads[6] < 130 and reads[8] == 80       # merged after every fourth batch
    assert store.runs() == [(0, 3), (4, 7), (8, 8)]
    empty = spark.createDataFrame([], "k long, v int, __START_AT timestamp_ntz, __END_AT timestamp_ntz")
    assert store.versions(empty).count() == 40 * 9 + 1 and store.current(empty).count() == 40


def test_a_large_batch_without_hot_keys_is_dealt_out_once(spark, tmp_path, monkeypatch):
    """More rows than a hot key has, none of them hot: no split into chunks, and the run is written as the rows lie."""
    def split(*a, **k):
        raise AssertionError("no key is hot")

    monkeypatch.setattr(state, "keyed_carry", split)
    store, seen = _store(spark, tmp_path / "s"), []
    for i in range(2):
        rows = [(k, i, i * 10 + d, "insert") for k in range(12) for d in (0, 3)]
        store.apply(_changes(spark, rows), i, hot_rows=20, fraction=1.0)
        seen += rows
    assert _versions(spark, store) == _expected(seen)


def test_only_deletes_of_a_key_leave_no_version(spark, tmp_path):
    store = _store(spark, tmp_path / "s")
    store.apply(_changes(spark, [(1, None, 3, "delete")]), 0)
    assert _versions(spark, store) == []
    store.apply(_changes(spark, [(1, 5, 1, "insert")]), 1)
    assert _versions(spark, store) == [(1, 5, ts(1), ts(3))]


def test_batch_with_nothing_clean_keeps_state(spark, tmp_path):
    root = str(tmp_path)
    arrivals = [[change(1, 10, 0, "insert")], [change(1, -5, 3, "update_postimage")]]
    for i, rows in enumerate(arrivals):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/feed/part{i}")
    got = run_history_stream(_stream(spark, root), E, 2, f"{root}/store", f"{root}/ck", buckets=4).history
    assert [(r["k"], r["v"], r["__END_AT"]) for r in got.collect()] == [(1, 10, None)]
