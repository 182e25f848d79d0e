"""Partition-wise merges and maintained totals against a rebuild."""

from __future__ import annotations

import glob
import random

from pyspark.sql import functions as F

from tessera.operators.partitions import PART, merge_partitions, month_of, read_partitioned, write_partitioned
from tessera.streaming.totals import Totals

SCHEMA = "id long, at timestamp_ntz, amount decimal(18,4)"


def rows_of(spark, rows):
    df = spark.createDataFrame([(i, d, a) for i, d, a in rows], "id long, d string, a string")
    return df.select("id", F.col("d").cast("timestamp_ntz").alias("at"), F.col("a").cast("decimal(18,4)").alias("amount"))


def content(df):
    return sorted((r["id"] if r["id"] is not None else -1, str(r["at"]), str(r["amount"])) for r in df.collect())


def files(path):
    return {p: set(glob.glob(f"{p}/*.parquet")) for p in glob.glob(f"{path}/{PART}=*")}


def test_merge_rewrites_touched_months_only(spark, tmp_path):
    path, part = str(tmp_path / "fact"), month_of(F.col("at"))
    base = [(i, f"2024-{i % 6 + 1:02d}-10 00:00:00", f"{i}.5") for i in range(60)] + [(900, None, "1"), (None, "2024-06-01 00:00:00", "7")]
    write_partitioned(rows_of(spark, base), path, part)
    before = files(path)
    # 1: new amount in January; 8: moves from March to February; 77: new in August; 900: gets a time; a NULL key never matches
    new = [(0, "2024-01-10 00:00:00", "99"), (8, "2024-02-20 00:00:00", "8"), (77, "2024-08-01 00:00:00", "1"),
           (900, "2024-08-02 00:00:00", "2")]
    touched = merge_partitions(rows_of(spark, new), path, ["id"], part)
    assert touched == ["2024-01", "2024-02", "2024-03", "2024-08", "none"]
    after = files(path)
    for month in ("2024-04", "2024-05", "2024-06"):
        (p,) = [x for x in before if x.endswith(month)]
        assert before[p] == after[p]
    assert not any(x.endswith("=none") for x in after)              # left without rows
    want = [r for r in base if r[0] not in {n[0] for n in new}] + new
    assert content(read_partitioned(spark, path)) == content(rows_of(spark, want))
    merge_partitions(rows_of(spark, new), path, ["id"], part)       # again: nothing changes
    assert content(read_partitioned(spark, path)) == content(rows_of(spark, want))
    assert merge_partitions(rows_of(spark, []), path, ["id"], part) == []


def test_totals_equal_a_rebuild(spark, tmp_path):
    """Rows come, change and go; a batch comes twice; levels merge."""
    rng = random.Random(5)
    totals = Totals(spark, str(tmp_path / "t"), {"month": month_of(F.col("at"))}, {"amount": F.col("amount")})
    current: dict[int, tuple] = {}
    for batch in range(6):
        delta = []
        for i in rng.sample(range(30), 12):
            if i in current:
                delta.append((*current.pop(i), -1))
            if rng.random() < 0.7:
                current[i] = (i, rng.choice(["2024-01-05 00:00:00", "2024-02-05 00:00:00", None]), rng.choice(["1.25", "-3", None]))
                delta.append((*current[i], 1))
        signed = spark.createDataFrame(delta, "id long, d string, a string, _sign int").select(
            F.col("d").cast("timestamp_ntz").alias("at"), F.col("a").cast("decimal(18,4)").alias("amount"), "_sign")
        for _ in range(1 + (batch in (2, 4))):
            totals.apply(signed, batch)
        want = rows_of(spark, list(current.values())).groupBy(month_of(F.col("at")).alias("month")) \
            .agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("amount"), F.count(F.lit(1)).alias("row_count"))
        assert sorted((r[0], float(r[1]), r[2]) for r in totals.read().collect()) == \
            sorted((r[0], float(r[1]), r[2]) for r in want.collect())
    assert totals.runs() == [(0, 3), (4, 4), (5, 5)]
