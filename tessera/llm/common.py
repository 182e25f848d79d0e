"""Helpers shared by the training-data operators: reading, intermediate tables, bounded bitmaps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, stored_bytes

SPACES = " \t\n\u000b\f\r"                      # \x20 and \x09-\x0D
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITMAP_BITS = 1 << 26                           # 8 MB: the size bound of a broadcast bitmap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Intermediate tables in the shared checkpoint folder.

    A written table cuts the lineage and survives lost executors.  ``drop`` removes
    tables that no later plan reads; tables behind a returned DataFrame stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bytes(self, name: str) -> int:
        return stored_bytes(self.spark, f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for path in [f"{self.base}/{n}" for n in names] or [self.base]:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def lower_az(c: Column) -> Column:
    """A-Z lower-cased, every other character unchanged."""
    return F.translate(c, UPPER, LOWER)


def words_of(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once (a one-element transform), so that its uses don't compute it again."""
    return F.transform(F.array(value), body)[0]


def sha(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def slot(c: Column, bits: int = BITMAP_BITS) -> Column:
    """Place of a long in a bitmap of ``bits`` (a power of two) bits."""
    return c.bitwiseAND(F.lit(bits - 1))


def bitmap(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bits set at ``slot(column)``, as bytes of the fixed size ``bits / 8``.

    The bitmap is aggregated on Spark in 4 KB pieces; whatever the number of keys, at
    most ``bits / 8`` bytes reach the driver.  A set bit means "perhaps a key": a user
    of the bitmap confirms exactly, so more keys only make it less selective.
    """
    pieces = keys.select((slot(F.col(column), bits) + 1).alias("b")) \
        .groupBy(F.bitmap_bucket_number("b").alias("k")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m"))
    out = np.zeros(bits // 8, np.uint8)
    for r in pieces.toLocalIterator():
        at = (r["k"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which int64 keys have their bit set."""
    s = keys.astype(np.uint64) & np.uint64(bits.size * 8 - 1)
    return (bits[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 == 1


def named(c: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col(f"`{c}`")


def others(df: DataFrame, new: Iterable[str]) -> list[str]:
    """The columns that stay beside ``new`` ones: a new column replaces an old one of its name."""
    low = {c.lower() for c in new}
    return [c for c in df.columns if c.lower() not in low]


def packed(df: DataFrame, keep: Iterable[str] | None = None, **columns: str) -> DataFrame:
    """``row``, a struct of the columns ``keep`` (all by default), and ``columns`` under fixed names.

    No column of ``df`` can then clash with the names that an operator works with."""
    return df.select(F.struct(*(named(c) for c in (df.columns if keep is None else keep))).alias("row"),
                     *(named(c).alias(k) for k, c in columns.items()))


def free_name(taken: Iterable[str], base: str) -> str:
    """``base``, with underscores until it clashes with none of ``taken`` (case-insensitively)."""
    low = {t.lower() for t in taken}
    while base.lower() in low:
        base = f"_{base}"
    return base
