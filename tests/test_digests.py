"""The digest tree gives the rows of the plain diff and reconciliation, and moves few of them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import digests
from tessera.operators.changes import reconcile, snapshot_diff
from tessera.session import cut_lineage


def ts():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def snapshots(spark, n=20000):
    old = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 97).cast("string").alias("a"),
                                F.when(F.col("id") % 5 != 0, F.col("id") / 3).alias("b"))
    new = old.where("k % 400 <> 1").withColumn("a", F.when(F.col("k") % 300 == 2, F.lit(None)).when(F.col("k") % 300 == 7, F.lit(""))
                                               .otherwise(F.col("a")))
    extra = spark.range(n, n + 40).select(F.col("id").alias("k"), F.lit("new").alias("a"), F.lit(None).cast("double").alias("b"))
    odd = spark.createDataFrame([(None, "x", 1.0), (None, None, None)], "k long, a string, b double")
    return cut_lineage(old.unionByName(odd), "old"), cut_lineage(new.unionByName(extra).unionByName(odd), "new")


@pytest.mark.parametrize("options", [{}, {"top": 8, "leaf_rows": 4}])
def test_same_rows_as_the_plain_diff(spark, options):
    old, new = snapshots(spark)
    got = digests.diff_by_digest(old, new, ["k"], 3, ts(), **options)
    want = snapshot_diff(old, new, ["k"], 3, ts())
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_few_rows_move(spark):
    """About one row in a hundred differs: below a tenth of the rows are joined."""
    old, new = snapshots(spark, 200_000)
    a, b = digests.differing(old, new, ["k"])
    assert 0 < a.count() < 0.1 * old.count() and 0 < b.count() < 0.1 * new.count()
    same, also = digests.differing(old, old, ["k"])
    assert same.count() == also.count() == 2                     # NULL keys match nothing


def test_reconcile_counts_matches_and_lists_the_rest(spark):
    old, new = (s.select("k", F.sha2(F.concat_ws("|", "a", "b"), 256).alias("WA_HASH")) for s in snapshots(spark))
    got = digests.reconcile_by_digest(old, new, ["k"]).collect()
    want = [tuple(r) for r in reconcile(old, new, ["k"]).collect()]
    assert sorted((r["k"], r["status"]) for r in got if r["status"] != "match" and r["k"] is not None) == \
        sorted(w for w in want if w[1] != "match" and w[0] is not None)
    (matches,) = [r for r in got if r["status"] == "match"]
    assert matches["key_count"] == sum(w[1] == "match" for w in want)


def test_empty_sides(spark):
    old, _ = snapshots(spark, 50)
    none = old.limit(0)
    assert digests.diff_by_digest(none, none, ["k"], 1, ts()).count() == 0
    assert digests.diff_by_digest(none, old, ["k"], 1, ts()).where("_change_type = 'insert'").count() == 52
    assert [tuple(r) for r in digests.reconcile_by_digest(none.withColumn("WA_HASH", F.lit("")), none.withColumn("WA_HASH", F.lit("")),
                                                          ["k"]).collect()] == [(None, "match", 0)]


def test_hashes_of_the_reconciliation_are_packed(spark, monkeypatch):
    """32 bytes of a hash are stored and shuffled, not its text."""
    from tessera.plans.registry import QUERIES
    seen, plain = [], digests.reconcile_by_digest
    monkeypatch.setattr(digests, "reconcile_by_digest", lambda s, t, *a: seen.extend([s, t]) or plain(s, t, *a))
    found = QUERIES["digest_reconcile"](spark, "/root/testdata/sf0.001")
    assert [df.schema["WA_HASH"].dataType.typeName() for df in seen] == ["binary", "binary"]
    assert found.columns == ["order_id", "status", "key_count"] and seen[0].where("length(WA_HASH) = 32").count() == seen[0].count()
