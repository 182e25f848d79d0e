"""Clustered writes: every key prunes files, skew and odd values included; no row is lost."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tessera.operators import layout
from tessera.operators.narrow import exchanged


def opened(spark, path, keys):
    """key -> (most files opened by one of its values, files)."""
    written = spark.read.parquet(path)
    ranges = layout.file_ranges(written, keys).cache()
    out = {}
    for k in keys:
        values = written.where(F.col(k).isNotNull()).select(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")).distinct()
        r = layout.files_opened(ranges, values).where(F.col("key") == k).agg(F.max("opened"), F.max("files")).first()
        out[k] = (r[0], r[1])
    return out


def test_a_filter_on_any_key_opens_at_most_half_of_the_files(spark, tmp_path):
    df = spark.range(0, 30000).select(
        (F.xxhash64("id", F.lit(1)) % 40).alias("truck"), (F.xxhash64("id", F.lit(2)) % 25).cast("string").alias("place"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.abs(F.xxhash64("id", F.lit(3))) % 2000).cast("int")).alias("day"),
        F.element_at(F.array(*map(F.lit, ("EUR", "USD", "GBP"))), (F.abs(F.xxhash64("id", F.lit(4))) % 3 + 1).cast("int")).alias("currency"),
        (F.col("id") / 7).cast("decimal(18,4)").alias("amount"))
    keys = ["truck", "place", "day", "currency"]
    path = str(tmp_path / "t")
    layout.clustered_write(df, path, keys)
    for most, files in opened(spark, path, keys).values():
        assert files > 100 and 2 * most <= files
    back = spark.read.parquet(path)
    assert back.columns == df.columns and back.exceptAll(df).count() == df.exceptAll(back).count() == 0


def test_correlated_keys_still_prune(spark, tmp_path):
    """A place belongs to one truck, and currency follows the place: most corners of the key space are empty."""
    df = spark.range(0, 20000).select((F.col("id") % 100).alias("place")) \
        .select((F.col("place") % 20).alias("truck"), "place", (F.col("place") % 4).alias("currency"))
    path = str(tmp_path / "t")
    layout.clustered_write(df, path, ["truck", "place", "currency"], files=32)
    for most, files in opened(spark, path, ["truck", "place", "currency"]).values():
        assert 2 * most <= files


def test_a_crowded_cell_is_split_over_files(spark, tmp_path):
    df = spark.range(0, 12000).select(F.when(F.col("id") < 6000, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    path = str(tmp_path / "t")
    layout.clustered_write(df, path, ["k"], files=12)
    sizes = [r["rows"] for r in layout.file_ranges(spark.read.parquet(path), ["k"]).collect()]
    assert sum(sizes) == 12000 and max(sizes) < 2000


def test_nulls_nan_repeats_and_empty_tables(spark, tmp_path):
    rows = [(None, float("nan"), "x"), (None, None, None), (1, 2.0, "é"), (1, 2.0, "é"), (-5, float("-inf"), "")] * 3
    df = spark.createDataFrame(rows, "a int, b double, c string")
    for name, table in (("odd", df), ("none", df.limit(0))):
        path = str(tmp_path / name)
        layout.clustered_write(table, path, ["a", "b", "c"], files=4)
        assert sorted(map(str, spark.read.schema(df.schema).parquet(path).collect())) == sorted(map(str, table.collect()))


def test_place_of_a_row_equals_its_column(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 9), rng.choice("abc"), rng.random()) for _ in range(200)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    cuts = [layout._cuts([r[i] for r in rows], 4) for i in range(3)]
    curve = layout._interleaved([layout._rank(F.col(k), df.schema[k].dataType, c) for k, c in zip("abc", cuts)], 4)
    got = df.select("a", "b", "c", curve.alias("z")).collect()
    assert all(r["z"] == layout._place(r[:3], cuts, 4) for r in got) and len({r["z"] for r in got}) > 50


def test_rows_are_shuffled_narrow_and_come_back_whole(spark, tmp_path, monkeypatch):
    """Decimals of 38 digits that fit in 18 are shuffled as those; what doesn't fit comes back too."""
    seen = []
    monkeypatch.setattr(layout, "exchanged", lambda df, exchange, *a: exchanged(df, lambda rows: seen.append(rows.dtypes) or exchange(rows), *a))
    df = spark.range(0, 3000).select(
        F.col("id").alias("k"), F.timestamp_add("DAY", (F.col("id") % 50).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("at"),
        F.when(F.col("id") % 7 != 0, F.col("id") / 7).cast("decimal(38,4)").alias("price"),
        F.when(F.col("id") % 9 == 0, F.lit("9" * 30)).otherwise("1").cast("decimal(38,4)").alias("big")) \
        .withColumn("load", F.when(F.col("k") % 4 != 0, F.col("at")))
    path = str(tmp_path / "t")
    layout.clustered_write(df, path, ["k", "at"], files=4)
    back = spark.read.parquet(path)
    assert back.dtypes == df.dtypes and back.exceptAll(df).count() == df.exceptAll(back).count() == 0
    assert {"price": "decimal(18,4)", "big": "decimal(18,4)"}.items() <= dict(seen[0]).items()
