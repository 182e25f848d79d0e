"""Streaming pipelines on the tagged source.

* :func:`run_quarantine_stream` appends failing rows to an append-only sink.
* :func:`run_history_stream` tags each micro-batch once, stops on a broken fail rule, and
  routes its rows: failing ones to quarantine, clean ones into the stored history, of which only the
  intervals that they fall into are read and written
  (:class:`~tessera.streaming.state.SpliceStore`; replay-safe).
* :func:`run_stream_static_asof` joins a change stream to static SCD2 history,
  each micro-batch with the batch as-of join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import quality
from tessera.operators.entity import Entity
from tessera.operators.keyed import global_row_number, sized_broadcast
from tessera.operators.quality import ADMIN
from tessera.operators.temporal import as_of_join
from tessera.session import CODEC, cut_lineage
from tessera.streaming.state import BATCH_BITS, SpliceStore


def _drain(df: DataFrame, target: str, checkpoint: str) -> None:
    q = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(target))
    q.awaitTermination()


def run_quarantine_stream(stream: DataFrame, e: Entity, target: str, checkpoint: str) -> str:
    """Append-only quarantine fed by a stream of staged changes."""
    _drain(quality.quarantine(quality.tag(stream, e), e), target, checkpoint)
    return target


def _drain_batches(stream: DataFrame, fn, checkpoint: str) -> None:
    q = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    q.awaitTermination()


@dataclass
class StreamedHistory:
    """What a drained history stream holds: ``history`` (SCD1 state or SCD2 versions), ``quarantine`` and
    ``rule_counts`` (violations by batch and rule, counted on the write that stores the batch)."""

    history: DataFrame
    quarantine: DataFrame
    rule_counts: DataFrame


def run_history_stream(stream: DataFrame, e: Entity, scd_type: int, root: str, checkpoint: str,
                       buckets: int | None = None, on_delta: Callable[[DataFrame, int], None] | None = None) -> StreamedHistory:
    """One stream into both history and quarantine: every row ends in exactly one of them.

    The fail rules are checked on the whole clean batch before anything is written, so a batch
    that breaks one stops the stream and leaves no trace; the corrected batch then takes its
    place.  Deletes are stored as intervals too, so arrival order does not matter: a late
    change that sorts before a stored delete cannot reopen the key.  Each change gets its
    surrogate when it arrives (batch number, then place by key and sequence), and a version has
    that of the change that opened it, so numbers never change afterwards.

    ``on_delta(rows, batch_id)`` is given each batch's signed change of the current versions (``_sign`` 1 or -1);
    after a failure it may be given a batch again.
    """
    if scd_type not in (1, 2):
        raise ValueError(f"SCD type must be 1 or 2, not {scd_type!r}")
    spark = stream.sparkSession
    store = SpliceStore.open(spark, root, e, buckets)

    def merge(batch: DataFrame, batch_id: int) -> None:
        tagged, counts = quality.store_tagged(quality.tag(batch, e), e, "tagged_batch")
        clean = quality.enforce_fail_rules(quality.clean(tagged), e)
        order = [*e.keys, e.sequence, *e.tiebreak]
        # the store holds a row's hash only where its typed columns don't give it back
        numbered = global_row_number(clean.withColumn("WA_HASH", quality.spare_hash(e)), order, "_place") \
            .withColumn(e.wk, F.lit(batch_id << BATCH_BITS).cast("long") + F.col("_place")).drop("_place")
        # numbering writes the batch, so a broken fail rule has stopped the run before this line
        quality.quarantine(tagged, e).write.mode("overwrite").option("compression", CODEC).parquet(f"{root}/quarantine/batch={batch_id}")
        if e.rules:
            counts.coalesce(1).write.mode("overwrite").parquet(f"{root}/rule_counts/batch={batch_id}")
        delta = store.apply(numbered, batch_id, deltas=on_delta is not None)
        if delta is not None and on_delta is not None:
            on_delta(delta.withColumn("WA_HASH", quality.whole_hash(e)), batch_id)

    _drain_batches(stream, merge, checkpoint)
    tagged = quality.tag(spark.createDataFrame([], stream.schema), e)
    clean = quality.clean(tagged).withColumns({e.wk: F.lit(0).cast("long"), "__START_AT": F.col(e.sequence), "__END_AT": F.col(e.sequence)})
    if scd_type == 1:
        found = store.current(clean.select(*e.column_names, *ADMIN, "__START_AT")).withColumnRenamed("__START_AT", "WA_FROMDATE")
    else:
        found = store.versions(clean.select(e.wk, *e.column_names, *ADMIN, "__START_AT", "__END_AT"))
    found = found.withColumn("WA_HASH", quality.whole_hash(e))
    bad = quality.quarantine(tagged, e)
    if e.rules:
        counts = spark.read.schema(f"{quality.COUNT_SCHEMA}, batch long").option("basePath", f"{root}/rule_counts") \
            .parquet(f"{root}/rule_counts/batch=*")
    else:
        counts = spark.createDataFrame([], f"{quality.COUNT_SCHEMA}, batch long")
    return StreamedHistory(found, spark.read.schema(bad.schema).parquet(f"{root}/quarantine/batch=*"), counts)


def run_stream_static_asof(stream: DataFrame, e: Entity, static_history: DataFrame, keys: list[str], at: str,
                           target: str, checkpoint: str, how: str = "inner", columns: Sequence[str] = ()) -> str:
    """Clean changes of a stream joined to the static history version valid at ``at``, of any entity and history:
    the entity's columns and the history's ``columns`` are written.

    Each micro-batch is a static frame, so it takes the batch as-of join (union
    plus carried window, hot keys split) over the versions of the batch's keys
    only: a key with many versions and many changes in one batch is never
    paired out, and the rest of the history is not moved.  Output goes to a
    folder per batch id, so a replayed batch overwrites its own rows.
    """

    versions = static_history.select(*dict.fromkeys([*keys, *columns, "WA_FROMDATE", "WA_UNTODATE"]))

    def join(batch: DataFrame, batch_id: int) -> None:
        lines = cut_lineage(quality.clean(quality.tag(batch, e)).select(*dict.fromkeys([*e.column_names, *keys, at])), "asof_batch")
        # only versions of the batch's keys take part: the history is filtered by a
        # semi join (the key set broadcast when its counted size allows), so a
        # micro-batch never shuffles the whole history
        batch_keys, _ = sized_broadcast(lines.select(*keys).distinct())
        history_part = versions.join(batch_keys, list(keys), "left_semi")
        j = as_of_join(lines, history_part, keys, at, how, names=("d", "h"))
        out = j.select(*[F.col(f"d.{c}").alias(c) for c in e.column_names],
                       *[F.col(f"h.{c}").alias(c) for c in columns])
        out.write.mode("overwrite").option("compression", CODEC).parquet(f"{target}/batch={batch_id}")

    _drain_batches(stream, join, checkpoint)
    return target
