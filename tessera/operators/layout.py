"""Physical layout of written tables: rows clustered along a space-filling curve, and what a filter then reads."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from heapq import heappop, heappush
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.narrow import exchanged
from tessera.session import CODEC

SAMPLE_ROWS = 50_000        # key rows sent to the driver to find cuts and boxes, or 20 per file: the bound of the sample
CELL_BITS = 18              # of the curve, to tell boxes apart


def _cuts(values: list[Any], bits: int) -> list[tuple[Any, int]]:
    """(smallest value, rank) of each rank that occurs, from sampled values; ranks are quantiles in 2^bits steps."""
    known = sorted(v for v in values if v is not None and v == v)
    first: dict[Any, int] = {}
    last: dict[Any, int] = {}
    for i in range(1, 1 << bits) if known else ():
        v = known[i * len(known) >> bits]
        first.setdefault(v, i)
        last[v] = i
    return [(v, first[v] + last[v] >> 1) for v in first]        # a value that spans several steps has the middle one


def _rank(key: Column, kind, cuts: list[tuple[Any, int]], below: int = 0) -> Column:
    """Rank of a value by binary search through the cuts; NULL ranks first."""
    if not cuts:
        return F.lit(below)
    mid = len(cuts) // 2
    value, rank = cuts[mid]
    return F.when(key >= F.lit(value).cast(kind), _rank(key, kind, cuts[mid + 1:], rank)) \
        .otherwise(_rank(key, kind, cuts[:mid], below))


def _interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The ranks' bits, highest first, taken from each key in turn."""
    out, place = F.lit(0).cast("long"), bits * len(ranks)
    for bit in reversed(range(bits)):
        for r in ranks:
            place -= 1
            out = out.bitwiseOR(F.shiftleft(F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long"), place))
    return out


def _place(row: Sequence[Any], cuts: list[list[tuple[Any, int]]], bits: int) -> int:
    """:func:`_interleaved` of one sampled row."""
    ranks = []
    for v, cut in zip(row, cuts):
        at = bisect_right([c for c, _ in cut], v) if v is not None and v == v else 0
        ranks.append(cut[at - 1][1] if at else 0)
    out = 0
    for bit in reversed(range(bits)):
        for r in ranks:
            out = out << 1 | r >> bit & 1
    return out


def _boxes(places: list[int], depth: int, files: int) -> list[tuple[int, int, int]]:
    """(first place, last place, share of ``files``) of boxes in curve order.

    The fullest box is halved, along the key whose bit is next, until there are enough: every file is
    a box of the key space, with no file across the border of two.  A single cell too full for one file
    has several."""
    heap = [(-len(places), 0, 0, sorted(places))]
    done, enough = [], max(1, len(places) // max(1, files))
    while heap and len(heap) + len(done) < files:
        n, prefix, level, mine = heappop(heap)
        if level == depth:
            done.append((prefix, max(1, -n // enough)))
            continue
        half = (2 * prefix + 1) << (depth - level - 1)
        at = bisect_left(mine, half)
        for p, part in ((2 * prefix, mine[:at]), (2 * prefix + 1, mine[at:])):
            if part:
                heappush(heap, (-len(part), p, level + 1, part))
    starts = sorted([(prefix << depth - level, 1) for _, prefix, level, _ in heap] + done) or [(0, 1)]
    ends = [first - 1 for first, _ in starts[1:]] + [(1 << depth) - 1]         # what no sampled row is in goes with the box before
    return [(first if i else 0, last, share) for i, ((first, share), last) in enumerate(zip(starts, ends))]


def clustered_write(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None,
                    mode: str = "overwrite", sample_rows: int = SAMPLE_ROWS) -> None:
    """Write rows clustered by ``keys``, each alike: a file covers a box of the key space, so Parquet's
    minima and maxima let a filter on any one of the keys skip files.

    Each key is ranked by quantiles of a sample (one count, one pass over the key columns), so skewed
    and correlated keys spread evenly and any orderable type will do.  The ranks' bits interleave to a
    Z curve; boxes of the curve with about equal rows in the sample become files.  Which box a row belongs to is
    looked up in a broadcast table of the curve's cells, at most ``2 ** CELL_BITS`` rows; the one shuffle of the
    rows is by box number.  ``files`` is the session's shuffle partitions by default, and at least eight
    for each corner of the key space.  ``df`` should be a stored table: it is read for the sample and again
    for the write.
    """
    spark = df.sparkSession
    n = files or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 << len(keys))
    depth = min(CELL_BITS, math.ceil(math.log2(max(2, n))) + 3)
    bits = -(-depth // len(keys))
    rows = df.select(*keys)
    fraction = min(1.0, max(sample_rows, 20 * n) / max(1, rows.count()))
    sample = [tuple(r) for r in (rows if fraction == 1.0 else rows.sample(fraction=fraction, seed=17)).collect()]
    cuts = [_cuts([r[i] for r in sample], bits) for i in range(len(keys))]
    curve = _interleaved([_rank(F.col(k), df.schema[k].dataType, c) for k, c in zip(keys, cuts)], bits)
    unused = bits * len(keys) - depth
    boxes = _boxes([_place(r, cuts, bits) >> unused for r in sample], depth, n)
    numbered, number = [], 0
    for first, last, share in boxes:
        numbered.append((first, last, number, share))
        number += share
    cells = spark.createDataFrame(numbered, "first long, last long, _box int, _share int") \
        .select(F.explode(F.sequence("first", "last")).alias("_cell"), "_box", "_share")
    placed = df.withColumn("_curve", curve).withColumn("_cell", F.shiftright("_curve", unused)).join(F.broadcast(cells), "_cell") \
        .withColumn("_box", F.col("_box") + F.pmod(F.xxhash64(*df.columns), F.col("_share")).cast("int"))
    time = next((k for k in keys if df.schema[k].dataType.typeName().startswith("timestamp")), None)
    exchanged(placed, lambda rows: rows.repartitionById(number, F.col("_box")), time, [*keys, "_box", "_curve"]) \
        .sortWithinPartitions("_curve", *keys).select(*df.columns).write.mode(mode).option("compression", CODEC).parquet(path)


def file_ranges(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per file: the range of each key (``<key>_lo``, ``<key>_hi``) and its rows."""
    return table.groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), *(f(k).alias(f"{k}_{e}") for k in keys for f, e in ((F.min, "lo"), (F.max, "hi"))))


def files_opened(ranges: DataFrame, probes: DataFrame) -> DataFrame:
    """For each probe (``key``, ``value`` as text by ``ranges``' type, one row per question) the files whose range
    holds it: ``opened`` of ``files``.  Files are compared with few probes, not with rows."""
    keys = [c[:-3] for c in ranges.columns if c.endswith("_lo")]
    parts = []
    for k in keys:
        value = F.col("value").cast(ranges.schema[f"{k}_lo"].dataType)
        hit = value.between(F.col(f"{k}_lo"), F.col(f"{k}_hi"))
        parts.append(F.broadcast(probes.where(F.col("key") == k)).crossJoin(ranges.select(f"{k}_lo", f"{k}_hi"))
                     .groupBy("key", "value").agg(F.count_if(hit).alias("opened"), F.count(F.lit(1)).alias("files")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
