"""History: SCD type 2 versions, the history view, SCD type 1 state, tracked columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import packed_hash, shown_hash
from tessera.operators.entity import Entity
from tessera.operators.keyed import (
    CHUNK_ROWS, HOT_KEY_ROWS, SAMPLE_FRACTION, _join_keys, global_row_number, keyed_carry, latest_per_key,
    number_in_place, range_lead, sized_broadcast,
)
from tessera.operators.quality import ADMIN, enforce_fail_rules, spare_hash, whole_hash
from tessera.session import cut_lineage

# Fixed value: open end of a current version.
OPEN_END = "9999-12-31 00:00:00"


def open_end():
    return F.lit(OPEN_END).cast("timestamp_ntz")


def _not(expr: str):
    return ~F.coalesce(F.expr(expr), F.lit(False))


def versions(changes: DataFrame, e: Entity, track: Sequence[str] | None = None, hot_rows: int = HOT_KEY_ROWS,
             chunk_rows: int = CHUNK_ROWS, fraction: float = SAMPLE_FRACTION) -> DataFrame:
    """SCD type 2 versions before numbering, in (key, start) order on their range layout, with every
    column of the changes, ``__START_AT``, ``__END_AT`` and ``_pos``, the place within the key (and
    hot-key chunk)."""
    rows = enforce_fail_rules(changes, e)
    if track:
        rows = tracked_changes(rows, e, track, hot_rows, chunk_rows, fraction)
    seq = e.sequence
    order = [seq, *e.tiebreak]
    rows = range_lead(rows, e.keys, order, seq, "__END_AT", hot_rows, chunk_rows, fraction, keep_chunk=True)
    part = [*e.keys, "_chunk"] if "_chunk" in rows.columns else list(e.keys)
    return (rows.where(F.col("__END_AT").isNull() | (F.col("__END_AT") != F.col(seq)))
            .where(_not(e.delete_when))
            .withColumn("_pos", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
            .withColumn("__START_AT", F.col(seq)))


def scd2(changes: DataFrame, e: Entity, track: Sequence[str] | None = None, hot_rows: int = HOT_KEY_ROWS,
         chunk_rows: int = CHUNK_ROWS, fraction: float = SAMPLE_FRACTION, with_root: bool = False,
         previous: DataFrame | None = None, hashed: bool = False) -> DataFrame:
    """SCD type 2 versions from clean change rows, keyed by ``e.keys`` and sequenced
    by ``e.sequence`` (tie-broken by ``e.tiebreak``).

    A version ends where the key's next change starts; the end is taken over all
    changes, deletes included, and only then are deletes removed, so a delete
    closes its predecessor and leaves no row.  Of several changes with one
    sequence value only the last by tie-break survives.  Input order does not
    matter.  ``WK_`` is ``row_number() OVER (ORDER BY keys, start)``; with
    ``previous``, the history as it was, versions known there (same key and start)
    keep their number and new ones follow its largest, so facts that hold numbers
    of a rebuilt history stay right.

    One range shuffle on (key, hot-key chunk) serves the ``lead``, the survivor
    filter, each version's place within its key and the numbering.  With
    ``with_root`` the key's first surrogate ``WKR_`` is added from that place
    (plus, for a split hot key, the survivors of its earlier chunks), so the
    history view needs no further shuffle.  ``hashed`` says that every ``WA_HASH`` is a row hash, which
    is then shuffled and stored, as its 32 bytes, only where the typed columns don't give it back.
    """
    if hashed:
        packed = changes.withColumn("WA_HASH", packed_hash(spare_hash(e)))
        return scd2(packed, e, track, hot_rows, chunk_rows, fraction, with_root, previous) \
            .withColumn("WA_HASH", whole_hash(e, shown_hash("WA_HASH")))
    found = versions(changes, e, track, hot_rows, chunk_rows, fraction)
    hot = "_chunk" in found.columns
    found = found.select(*e.column_names, *ADMIN, "__START_AT", "__END_AT", "_pos", *(["_chunk", "_hot"] if hot else []))
    cols = [e.wk, *e.column_names, *ADMIN, "__START_AT", "__END_AT"]
    if previous is not None:
        return _renumbered(found, previous, e).select(*cols)
    numbered = number_in_place(found, e.wk, [*e.keys, "__START_AT"])
    if not with_root:
        return numbered.select(*cols)
    root = F.col(e.wk) - F.col("_pos") + 1
    if hot:
        counts = numbered.where("_hot").groupBy(*e.keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy(*e.keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        prior = counts.select(*e.keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_prior"))
        prior_b, _ = sized_broadcast(prior)         # one row per chunk of a hot key
        numbered = _join_keys(numbered, prior_b, list(e.keys), "left", extra=["_chunk"])
        root = root - F.coalesce(F.col("_prior"), F.lit(0))
    return numbered.select(*cols, root.cast("long").alias(e.wkr))


def _renumbered(found: DataFrame, previous: DataFrame, e: Entity) -> DataFrame:
    """Stored numbers where key and start are known, new ones above the largest stored number."""
    at = [*e.keys, "__START_AT"]
    old = previous.select(*at, F.col(e.wk).alias("_old"))
    both = cut_lineage(found.drop("_pos").join(old, at, "left"), "renumbered")
    new = global_row_number(both.where("_old is null").drop("_old"), at, e.wk)
    top = F.coalesce(previous.agg(F.max(e.wk)).scalar(), F.lit(0))
    kept = both.where("_old is not null").withColumnRenamed("_old", e.wk)
    return kept.unionByName(new.withColumn(e.wk, (F.col(e.wk) + top).cast("long")))


def history_view(dw: DataFrame, e: Entity, hot_rows: int = HOT_KEY_ROWS, chunk_rows: int = CHUNK_ROWS,
                 fraction: float = SAMPLE_FRACTION) -> DataFrame:
    """Every version with validity columns, and the surrogates of the key's previous and first
    version by start.

    A history that carries ``WKR_`` (``scd2(with_root=True)``) is numbered consecutively within
    each key in start order, so the view is a projection.  Any other numbering (kept over
    rebuilds, or given by a stream in order of arrival) takes the previous surrogate from a
    carried window per (key, hot-key chunk), and the first one from a grouped ``min_by``."""
    if e.wkr in dw.columns:
        v, before = dw, F.when(F.col(e.wk) > F.col(e.wkr), F.col(e.wk) - 1)
    else:
        root = dw.groupBy(*e.keys).agg(F.min_by(e.wk, "__START_AT").alias(e.wkr))
        v = keyed_carry(dw, e.keys, ["__START_AT"], e.wk, "_prev", hot_rows, chunk_rows, fraction, include_current=False)
        v, before = _join_keys(v, root, list(e.keys), "left"), F.col("_prev")
    return v.select(
        e.wk,
        before.alias(e.wkp),
        e.wkr,
        *e.column_names,
        F.col("__START_AT").alias("WA_FROMDATE"),
        F.coalesce(F.col("__END_AT"), open_end()).alias("WA_UNTODATE"),
        F.when(F.col("__END_AT").isNull(), 1).otherwise(0).alias("WA_ISCURR"),
        *ADMIN,
    )


def scd1(changes: DataFrame, e: Entity) -> DataFrame:
    """SCD type 1: the current state per key (last change by sequence; a delete
    removes the key)."""
    rows = enforce_fail_rules(changes, e)
    last = latest_per_key(rows, e.keys, [e.sequence, *e.tiebreak])
    return last.where(_not(e.delete_when)).select(*e.column_names, *ADMIN, F.col(e.sequence).alias("WA_FROMDATE"))


def tracked_changes(changes: DataFrame, e: Entity, track: Sequence[str], hot_rows: int = HOT_KEY_ROWS,
                    chunk_rows: int = CHUNK_ROWS, fraction: float = SAMPLE_FRACTION) -> DataFrame:
    """Keep only changes that alter the tracked columns, compared by value (NULL differs
    from an empty string).  A delete, and the change after a delete, always count.

    The previous change of each key is a ``lag`` per (key, hot-key chunk)
    (:func:`~tessera.operators.keyed.keyed_carry` ending one row back), so a
    hot key is never sent to one task.
    """
    is_del = F.coalesce(F.expr(e.delete_when), F.lit(False))
    sig = F.struct(F.struct(*track).alias("v"), is_del.alias("d"))
    rows = keyed_carry(changes.withColumn("_sig", sig), e.keys, [e.sequence, *e.tiebreak], "_sig", "_prev",
                       hot_rows, chunk_rows, fraction, include_current=False)
    keep = (F.col("_prev").isNull() | F.col("_sig.d") | F.col("_prev.d")
            | ~F.col("_prev.v").eqNullSafe(F.col("_sig.v")))
    return rows.where(keep).drop("_sig", "_prev")


def deleted_keys(dwh: DataFrame, e: Entity) -> DataFrame:
    """Keys whose last version is end-dated (no current version remains)."""
    return dwh.groupBy(*e.keys).agg(F.max("WA_ISCURR").alias("_cur"), F.max("WA_UNTODATE").alias("deleted_at"),
                                    F.count(F.lit(1)).alias("versions")) \
        .where(F.col("_cur") == 0).drop("_cur")


def version_path(dwh: DataFrame, e: Entity) -> DataFrame:
    """The versions of every key that has more than one, numbered in start order."""
    by_start = Window.partitionBy(*e.keys).orderBy("WA_FROMDATE")
    return dwh.withColumn("version_no", F.row_number().over(by_start)) \
        .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*e.keys))).where("_n > 1").drop("_n")
