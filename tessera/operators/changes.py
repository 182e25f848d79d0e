"""Change data: change-type filters, feeds from snapshots, snapshots from feeds,
version history and table-change statements expressed as next snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keyed import latest_per_key

APPLIED = ("insert", "update_postimage", "delete")


def cdc_filter(feed: DataFrame) -> DataFrame:
    """Keep inserts, update post-images and deletes; drop pre-images."""
    return feed.where(F.col("_change_type").isin(*APPLIED))


def crud_code(change_type: Column) -> Column:
    """insert/update_postimage/delete to C/U/D."""
    return (F.when(change_type == "insert", "C").when(change_type == "update_postimage", "U")
            .when(change_type == "delete", "D"))


def changes_from(feed: DataFrame, version: int = 0) -> DataFrame:
    """The change feed from a starting version on (a pushed-down filter)."""
    return feed.where(F.col("_commit_version") >= version)


def cdc_adapter(cdc: DataFrame, op_col: str = "op", seq_col: str = "lsn", ts_col: str = "op_ts",
                source: str = "cdc") -> DataFrame:
    """Map a CDC table with native metadata (operation code I/U/D, log sequence,
    operation time) to the change-feed shape with staging admin columns."""
    op = F.upper(F.col(op_col))
    change = F.when(op == "I", "insert").when(op == "U", "update_postimage").when(op == "D", "delete") \
        .when(op == "B", "update_preimage")
    return cdc.select(
        *[c for c in cdc.columns if c not in (op_col, seq_col, ts_col)],
        F.col(seq_col).cast("bigint").alias("_commit_version"),
        F.col(ts_col).alias("_commit_timestamp"),
        change.alias("_change_type"),
        F.col(ts_col).alias("SA_CRUDDTS"),
        F.lit(source).alias("SA_SRC"),
        F.concat(F.lit("v"), F.col(seq_col).cast("string")).alias("SA_RUNID"),
    )


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int, ts: Column | str) -> DataFrame:
    """Change feed between two snapshots: inserts, deletes and update pre/post pairs.

    A full outer join on the key; rows are compared by their values (a NULL differs from an
    empty string), and an update explodes into its pre- and post-image.  Unchanged rows produce
    nothing.  The key is a primary key: plain equality, so a NULL key never matches (as in MERGE)
    and the join reuses a partitioning on the key that the inputs already have.
    """
    cols = [c for c in new.columns if c not in keys]
    o = old.select(*keys, F.struct(*cols).alias("_o"), F.lit(True).alias("_was"))
    n = new.select(*keys, F.struct(*cols).alias("_n"), F.lit(True).alias("_is"))
    j = o.join(n, [o[k] == n[k] for k in keys], "full_outer") \
        .select(*[F.coalesce(o[k], n[k]).alias(k) for k in keys], "_o", "_n", "_was", "_is")
    pre = F.struct(F.lit("update_preimage").alias("t"), F.col("_o").alias("v"))
    post = F.struct(F.lit("update_postimage").alias("t"), F.col("_n").alias("v"))
    ins = F.struct(F.lit("insert").alias("t"), F.col("_n").alias("v"))
    dele = F.struct(F.lit("delete").alias("t"), F.col("_o").alias("v"))
    both = F.col("_was").isNotNull() & F.col("_is").isNotNull() & ~F.col("_o").eqNullSafe(F.col("_n"))
    events = F.array_compact(F.array(
        F.when(F.col("_was").isNull(), ins), F.when(F.col("_is").isNull(), dele),
        F.when(both, pre), F.when(both, post)))
    return j.select(*keys, F.explode(events).alias("_e")).select(
        *keys, *[F.col(f"_e.v.{c}").alias(c) for c in cols],
        F.col("_e.t").alias("_change_type"),
        F.lit(version).cast("bigint").alias("_commit_version"),
        (F.col(ts) if isinstance(ts, str) else ts).alias("_commit_timestamp"),
    )


def as_of(feed: DataFrame, keys: Sequence[str], version: int | None = None, ts: str | None = None,
          tiebreak: Sequence[str] = ()) -> DataFrame:
    """Snapshot of a table at a version or a timestamp, replayed from its feed:
    the last applied change per key at or before the point, deletes removed."""
    rows = cdc_filter(feed)
    if version is not None:
        rows = rows.where(F.col("_commit_version") <= version)
    if ts is not None:
        rows = rows.where(F.col("_commit_timestamp") <= F.lit(ts).cast("timestamp_ntz"))
    last = latest_per_key(rows, keys, ["_commit_version", "_commit_timestamp", *tiebreak])
    return last.where(F.col("_change_type") != "delete")


def version_history(feed: DataFrame) -> DataFrame:
    """One row per commit: time, operation counts, and the previous/earliest picks."""
    h = feed.groupBy("_commit_version").agg(
        F.min("_commit_timestamp").alias("first_commit_ts"),
        F.max("_commit_timestamp").alias("last_commit_ts"),
        F.count_if(F.col("_change_type") == "insert").alias("inserted"),
        F.count_if(F.col("_change_type") == "update_postimage").alias("updated"),
        F.count_if(F.col("_change_type") == "delete").alias("deleted"),
        F.count(F.lit(1)).alias("change_rows"),
    )
    v = feed.select(F.col("_commit_version").alias("v"))
    newest, earliest = v.agg(F.max("v")).scalar(), v.agg(F.min("v")).scalar()
    previous = v.where(F.col("v") < newest).agg(F.max("v")).scalar()
    return h.withColumn("is_previous", F.coalesce(F.col("_commit_version") == previous, F.lit(False))) \
        .withColumn("is_earliest", F.col("_commit_version") == earliest)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``MERGE ... WHEN NOT MATCHED THEN INSERT``: target plus source rows whose key is
    absent (anti join; a NULL key never matches, as in MERGE)."""
    return target.unionByName(source.join(target.select(*keys), list(keys), "left_anti"))


def update_where(df: DataFrame, condition: str | Column, assignments: dict[str, Column]) -> DataFrame:
    """``UPDATE ... SET ... WHERE``: the next snapshot."""
    cond = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    return df.withColumns({c: F.when(cond, v).otherwise(F.col(c)) for c, v in assignments.items()})


def delete_where(df: DataFrame, condition: str | Column) -> DataFrame:
    """``DELETE ... WHERE``: rows where the condition is not TRUE stay (NULL stays)."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.where(~F.coalesce(cond, F.lit(False)))


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str], hash_col: str = "WA_HASH") -> DataFrame:
    """Source-to-target reconciliation by row hash: key plus status.  Keys are
    primary keys compared with plain equality (a NULL key never matches)."""
    s = source.select(*keys, F.col(hash_col).alias("_sh"))
    t = target.select(*keys, F.col(hash_col).alias("_th"))
    j = s.join(t, [s[k] == t[k] for k in keys], "full_outer")
    status = (F.when(F.col("_th").isNull(), "missing_in_target").when(F.col("_sh").isNull(), "missing_in_source")
              .when(F.col("_sh") == F.col("_th"), "match").otherwise("mismatch"))
    return j.select(*[F.coalesce(s[k], t[k]).alias(k) for k in keys], status.alias("status"))
