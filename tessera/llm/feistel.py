"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows are numbered 0..N-1 by an order of the data (not by file or partition), the number
goes through a keyed bijection of 0..N-1, and the result alone gives shard and slot:
``shard = p % shards``, ``slot = p // shards``.  The law is ``rows``: shard counts differ by
at most one and slots have no gap.  The same data, seed and shard count give the same
places on any cluster.

The bijection is a Feistel network on Z_a x Z_b with a = ceil(sqrt(N)), b = ceil(N / a);
odd rounds add a keyed hash of one half to the other half.  The fewer than a points of the
domain at or above N are walked on until they fall below N.

Nulls: a null key sorts first, a null text has no bytes.  Rows equal in every order column
take their places in any order among themselves.  An empty table gives an empty result.

Native: DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, free_name, let, named, others, table

ROUNDS = 6
SEED = 20
SHARDS = 24


def domain(n: int) -> tuple[int, int]:
    """a x b: the smallest near-square domain that holds n row numbers."""
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _div(x: Column, by: int) -> Column:
    """Integer division of a non-negative long."""
    return F.call_function("div", x, F.lit(by).cast("long"))


def _round(half: Column, seed: int, i: int, size: int) -> Column:
    """60 bits of md5(seed:round:half), reduced to the other half's size."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{i}:"), half.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(size)


def permute(p: Column, n: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """The place of row number ``p`` among ``n`` rows: a bijection of 0..n-1."""
    a, b = domain(n)

    def left(i: int) -> Callable[[Column], Column]:
        return lambda s: F.struct(((s["l"] + _round(s["r"], seed, i, a)) % F.lit(a)).alias("l"), s["r"].alias("r"))

    def right(i: int) -> Callable[[Column], Column]:
        return lambda s: F.struct(s["l"].alias("l"), ((s["r"] + _round(s["l"], seed, i, b)) % F.lit(b)).alias("r"))

    def once(x: Column) -> Column:
        out = let(x, lambda v: F.struct(_div(v, b).alias("l"), (v % F.lit(b)).alias("r")))
        for i in range(rounds):
            out = let(out, right(i) if i % 2 else left(i))
        return let(out, lambda s: s["l"] * F.lit(b) + s["r"])

    outside = a * b - n
    if outside <= 0:
        return once(p)
    # a walk leaves the outside points after at most as many steps as there are such points
    return let(once(p), lambda y: F.when(y < n, y).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.lit(outside)), y, lambda acc, _: F.when(acc < n, acc).otherwise(once(acc)))))


def numbered(df: DataFrame, order: Sequence[str], name: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """``df`` with ``name`` = 0..N-1 in the order of the columns ``order``, and N.

    One range shuffle with a sort inside the partitions; the table is written once with each
    row's partition and place, and a table of one row per partition turns them into numbers.
    The sequence of the scan breaks ties, so even fully equal rows spread over partitions.
    """
    tie, part, place = (free_name(df.columns, c) for c in ("tie", "part", "place"))
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order, tie) \
        .sortWithinPartitions(*order, tie).drop(tie) \
        .withColumn(part, F.spark_partition_id()) \
        .withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    stored = scratch.write(ranged, "numbered")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = scratch.write(stored.groupBy(part).agg(F.count(F.lit(1)).alias("rows")), "counts")
    offsets = counts.select(part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    n = counts.agg(F.sum("rows")).first()[0] or 0
    offset = free_name(df.columns, "offset")
    out = stored.join(F.broadcast(offsets.withColumnRenamed("offset", offset)), part) \
        .withColumn(name, F.col(offset) + F.col(place)).drop(part, place, offset)
    return out, n


def shuffle_shards(df: DataFrame, order: Sequence[str], shards: int = SHARDS, seed: int = SEED,
                   shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``df`` with a shard (0..shards-1) and a gapless slot in it for every row (old columns of these names go)."""
    if shards < 1:
        raise ValueError("at least one shard")
    df = df.select(*(named(c) for c in others(df, {shard, slot} - set(order))))
    row = free_name(df.columns, "row_number")
    out, n = numbered(df, order, row, Scratch(df.sparkSession, "feistel"))
    if not n:
        return out.withColumns({shard: F.lit(0).cast("int"), slot: F.col(row)}).drop(row)
    place = free_name(df.columns, "place")
    return out.withColumn(place, permute(F.col(row), n, seed)) \
        .withColumns({shard: (F.col(place) % F.lit(shards)).cast("int"),
                      slot: _div(F.col(place), shards)}) \
        .drop(row, place)


def write_shards(df: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder per shard, rows in slot order; range partitioning splits shards over tasks."""
    df.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)


def op10_feistel_shards(spark, sf_dir: str) -> DataFrame:
    """Shard and slot of every document: law ``rows``, numbered by doc_id, then text."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    scratch = Scratch(spark, "feistel-rows")
    slim = scratch.write(table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash")), "rows")
    out = shuffle_shards(slim, ["doc_id", "text_hash"])
    scratch.drop()
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
