"""Lineage analysis over an edge table (source -> target)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

EDGE_COLS = ("source_table_full_name", "target_table_full_name", "entity_type", "created_by", "created_at")


def lineage_direct(edges: DataFrame, targets: list[str], n: int = 20) -> DataFrame:
    """Direct upstream edges of each target, newest first, at most ``n`` per target."""
    from pyspark.sql import Window
    low = [t.lower() for t in targets]
    w = Window.partitionBy(F.lower("target_table_full_name")).orderBy(F.desc("created_at"),
                                                                      "source_table_full_name")
    return (edges.where(F.lower("target_table_full_name").isin(*low))
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn"))


def lineage_walk(edges: DataFrame, start: str, direction: str = "downstream", max_depth: int = 5) -> DataFrame:
    """Edges reachable from ``start`` within ``max_depth`` steps, with their depth.

    The recursion is unrolled into at most ``max_depth - 1`` semi joins.  Each
    step carries only distinct (depth, edge) rows, so paths never multiply; the
    result is distinct, as a recursive UNION ALL followed by DISTINCT.  Each
    level is written once (shared checkpoint folder), so level ``d`` scans the
    edge table once instead of re-deriving every earlier level; the row count
    observed on that write ends the walk early at an empty level.  The level
    loop runs on the driver but is bounded by the depth cap, not by data.
    """
    if direction == "downstream":
        near, far = "source_table_full_name", "target_table_full_name"
    elif direction == "upstream":
        near, far = "target_table_full_name", "source_table_full_name"
    else:
        raise ValueError(direction)
    e = edges.select(*EDGE_COLS).withColumn("_near", F.lower(near))
    level, n = materialize(e.where(F.col("_near") == start.lower()).drop("_near")
                           .withColumn("depth", F.lit(1)).distinct(), "lineage_level")
    levels = [level]
    for d in range(2, max_depth + 1):
        if n == 0:          # counted on the write: an empty level ends the walk
            break
        frontier = level.select(F.lower(far).alias("_near")).distinct()
        level, n = materialize(e.join(frontier, "_near", "left_semi").drop("_near")
                               .withColumn("depth", F.lit(d)).distinct(), "lineage_level")
        levels.append(level)
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out.select("depth", *EDGE_COLS).distinct()


def lineage_impact(edges: DataFrame, start: str, layers: dict[str, str] | None = None) -> DataFrame:
    """Tables impacted directly or one hop later by a change of ``start``, with a
    layer label from the table name."""
    layers = layers or {"integration": "Silver", "datamart": "Gold"}
    s = start.lower()
    first = edges.where(F.lower("source_table_full_name") == s).select(F.lower("target_table_full_name").alias("_t"))
    hop = edges.join(first, F.lower(edges.source_table_full_name) == F.col("_t"), "left_semi")
    direct = edges.where(F.lower("source_table_full_name") == s)
    label = None
    for word, name in layers.items():
        cond = F.lower("target_table_full_name").like(f"%{word.lower()}%")
        label = F.when(cond, name) if label is None else label.when(cond, name)
    return (direct.unionByName(hop)
            .select(F.col("target_table_full_name").alias("impacted_table"), label.otherwise("Other")
                    .alias("medallion_layer"), "entity_type", "created_by")
            .distinct())
