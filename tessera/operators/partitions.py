"""Facts kept in partitions: a merge rewrites the partitions that its rows touch and no others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage

PART = "_part"


def month_of(time: Column) -> Column:
    """Partition value of a time: its month, and ``none`` for NULL."""
    return F.coalesce(F.date_format(time, "yyyy-MM"), F.lit("none"))


def write_partitioned(fact: DataFrame, path: str, part: Column) -> None:
    """The fact by partition, a large one over several files."""
    fact.withColumn(PART, part).hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(path)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)


def merge_partitions(new: DataFrame, path: str, keys: Sequence[str], part: Column) -> list[str]:
    """Upsert ``new`` into the fact at ``path`` by key; returns the partitions it touched.

    Touched are the partitions that the new rows belong to and those in which rows of their keys lie (a
    row may have moved); the latter are found by a semi join that reads the stored keys only.  Their merged
    rows are staged, then written with dynamic partition overwrite; partitions left without rows are removed.
    Files of all other partitions stay as they are.  A merge that failed half way may simply run again.  NULL keys never
    match, as in MERGE."""
    spark = new.sparkSession
    rows = cut_lineage(new.withColumn(PART, part), "merge_new")
    stored = spark.read.schema(rows.schema).parquet(path)           # as declared, partition values stay strings
    mine = rows.select(*keys)
    old = stored.select(*keys, PART).join(mine, list(keys), "left_semi").select(PART)
    touched = sorted(r[0] for r in rows.select(PART).union(old).distinct().collect())       # months, not rows
    if not touched:
        return []
    kept = stored.where(F.col(PART).isin(touched)).join(mine, list(keys), "left_anti")
    merged = cut_lineage(kept.unionByName(rows), "merged")
    merged.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    left = {r[0] for r in merged.select(PART).distinct().collect()}
    for gone in sorted(set(touched) - left):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{PART}={gone}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return touched
