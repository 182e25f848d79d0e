"""Reconciliation of two stored tables by a two-level digest tree: rows move only where digests differ.

A row's place in the tree is the hash of its key; a bucket's digest is the number of its rows and two XORs of
64-bit row hashes, which don't depend on order.  First the ``TOP`` buckets of both sides are compared; in those
that differ, their leaves (about ``LEAF_ROWS`` rows each); only rows of leaves that differ are joined.
Both levels are partial aggregates, so what is shuffled of equal rows is an eighth of a digest each.

Differing rows with equal digests would need 128 equal bits.  Rows whose key has a NULL match nothing
and always count as different.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.changes import reconcile, snapshot_diff

TOP = 4096              # buckets of the first level
LEAF_ROWS = 8           # of a leaf, on average


def _hash(columns: Sequence[str], salt: int) -> Column:
    """Hash of values that tells NULL from any other value and where one ends."""
    return F.xxhash64(F.lit(salt), *(x for c in columns for x in (F.col(c).isNull(), F.col(c))))


def _digest(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("_h1").alias("x1"), F.bit_xor("_h2").alias("x2"))


def _unequal(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups whose digests are not the same, as one sum of both sides (a group of one side differs too)."""
    side = left.withColumn("_s", F.lit(1)).unionByName(right.withColumn("_s", F.lit(2)))
    digest = F.struct("n", "x1", "x2")
    return side.groupBy(*by).agg(F.sum("_s").alias("_sides"), F.min(digest).alias("_lo"), F.max(digest).alias("_hi")) \
        .where((F.col("_sides") != 3) | (F.col("_lo") != F.col("_hi"))).select(*by)


def differing(left: DataFrame, right: DataFrame, keys: Sequence[str], leaf_rows: int = LEAF_ROWS, top: int = TOP
              ) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that lie in leaves with unequal digests, or have a NULL in their key."""
    columns = left.columns
    total = left.select(F.count(F.lit(1)).alias("n")).unionAll(right.select(F.count(F.lit(1)).alias("n"))).agg(F.max("n")).first()[0]
    leaves = max(1, total // (leaf_rows * top))
    null_key = F.greatest(*(F.col(k).isNull() for k in keys)) if len(keys) > 1 else F.col(keys[0]).isNull()

    def placed(df: DataFrame) -> DataFrame:
        place = _hash(keys, 0)
        return df.withColumns({"_top": F.pmod(place, F.lit(top)).cast("int"),
                               "_leaf": F.pmod(F.shiftrightunsigned(place, 20), F.lit(leaves)).cast("long"),
                               "_h1": _hash(columns, 1), "_h2": _hash(columns, 2)})

    l, r = placed(left), placed(right.select(*columns))
    tops = F.broadcast(_unequal(_digest(l, ["_top"]), _digest(r, ["_top"]), ["_top"]))          # at most ``top`` rows
    l, r = l.join(tops, "_top", "left_semi"), r.join(tops, "_top", "left_semi")
    at = ["_top", "_leaf"]
    odd = _unequal(_digest(l, at), _digest(r, at), at)

    def mine(rows: DataFrame, whole: DataFrame) -> DataFrame:
        found = rows.join(odd, at, "left_semi").where(~null_key).select(*columns).unionByName(whole.select(*columns).where(null_key))
        return found.select(*(F.col(c).alias(c) for c in columns))      # columns of its own, though both sides come from both tables

    return mine(l, left), mine(r, right)


def diff_by_digest(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int, ts: Column | str, **options) -> DataFrame:
    """:func:`~tessera.operators.changes.snapshot_diff` of two stored snapshots."""
    a, b = differing(old.select(*new.columns), new, keys, **options)
    return snapshot_diff(a, b, keys, version, ts)


def reconcile_by_digest(source: DataFrame, target: DataFrame, keys: Sequence[str], hash_col: str = "WA_HASH", **options) -> DataFrame:
    """status, key_count, and for what does not match the keys themselves: one row per key that is missing or
    differs, and one row (NULL keys) that counts the matches."""
    s, t = source.select(*keys, hash_col), target.select(*keys, hash_col)
    a, b = differing(s, t, keys, **options)
    found = reconcile(a, b, keys, hash_col)
    one = F.count(F.lit(1))
    same = found.where("status = 'match'").agg(one).scalar()
    nothing = [F.lit(None).cast(s.schema[k].dataType).alias(k) for k in keys]
    matches = s.agg(one.alias("n")).select(*nothing, F.lit("match").alias("status"),
                                           (F.col("n") - a.agg(one).scalar() + same).alias("key_count"))
    return found.where("status <> 'match'").withColumn("key_count", F.lit(1).cast("long")).unionByName(matches)
