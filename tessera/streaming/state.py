"""History kept by a stream as spliced intervals in merged runs.

Every change of a key opens an interval ``[start, end)`` that ends where the key's next change starts
(NULL: still open); deletes are intervals too, and a *root* interval (NULL start) stands before a
key's first change.  The intervals of a key therefore cover all time, and a new change at ``t`` falls into exactly
one stored interval: it takes the rest of it, and the stored one now ends at ``t``.  A batch reads
and writes these intervals only, however long the history is:

* Stored intervals that may hold one of the batch's times are found by bucket folder, by the times'
  range (``start <= last`` and ``end > first``, pushed to the Parquet scan; runs are sorted by end, so closed
  history is skipped by row group) and by a join with the batch's keys and their first and last time.
* The batch's changes and the found intervals are ordered per key (hot keys in chunks): a change ends at
  the next change of the batch or at the end of the interval that it falls into, whichever is first.
* New and shortened intervals go to a run of their own, ``runs/<first batch>-<last batch>``.  Unless a key is hot, one
  shuffle by parts of buckets serves the order per key and the run's files.

Splicing only shortens intervals, so of several rows for one start the one of the newest batch counts.
Every ``FAN``-th batch merges the runs of its level to one, dropping rows that a newer one replaces;
there are at most ``(FAN - 1) * log(batches)`` runs at any time and a row is rewritten once per level.  A run that another run
covers is not read and is removed; a replayed batch reads only what was there before it and rewrites its
own run, so nothing has to be remembered besides the folders.

Of several changes with one key and sequence value the last by tie-break counts.  A NULL sequence
stops the batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.entity import Entity
from tessera.operators.keyed import (
    CHUNK_ROWS, HOT_KEY_ROWS, SAMPLE_FRACTION, _join_keys, _partitions, hot_keys, keyed_carry, latest_per_key, range_lead,
)
from tessera.session import CODEC, cut_lineage, materialize

BATCH_BITS = 40         # a surrogate is the batch number, then the change's place in the batch
FAN = 4                 # runs of one level that are merged to one of the next
START, END, ROOT, AT = "__START_AT", "__END_AT", "_root", "_batch"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a file-system glob (a listing on the driver, no Spark job)."""
    p, fs = _fs(spark, pattern)
    found = fs.globStatus(p)
    return [str(st.getPath().toString()) for st in found] if found else []


@dataclass
class Runs:
    """Folders ``runs/<first batch>-<last batch>`` below ``root``: one per batch, merged by level."""

    spark: SparkSession
    root: str

    def runs(self, before: int | None = None) -> list[tuple[int, int]]:
        """(first, last) of the complete runs that no other run covers, up to the batch ``before``."""
        done = [p.rsplit("/", 2)[1] for p in _glob(self.spark, f"{self.root}/runs/*/_SUCCESS")]
        spans = [tuple(map(int, name.split("-"))) for name in done]
        spans = [s for s in spans if before is None or s[1] < before]
        return sorted(s for s in spans if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in spans))

    def _path(self, span: tuple[int, int]) -> str:
        return f"{self.root}/runs/{span[0]:06d}-{span[1]:06d}"

    def _merge(self, batch_id: int) -> None:
        """Merge the last runs of a level before batch ``batch_id``; all of their batches are done for good by then."""
        width = 1
        while batch_id and batch_id % (width * FAN) == 0:
            width *= FAN
        live = [s for s in self.runs(before=batch_id) if s[0] >= batch_id - width]
        if width > 1 and len(live) > 1:
            self._combine(live, (batch_id - width, batch_id - 1))
        keep = self.runs(before=batch_id)
        for name in [p.rsplit("/", 1)[1] for p in _glob(self.spark, f"{self.root}/runs/*")]:
            first, last = map(int, name.split("-"))
            if last < batch_id and (first, last) not in keep:
                p, fs = _fs(self.spark, f"{self.root}/runs/{name}")
                fs.delete(p, True)

    def _combine(self, live: list[tuple[int, int]], span: tuple[int, int]) -> None:
        raise NotImplementedError


@dataclass
class SpliceStore(Runs):
    """Intervals of one entity below ``root``.

    The number of buckets is fixed when the store is created and is part of its path, so a later run with other
    settings finds the same buckets.  ``visible`` is the SQL condition of a change that is a version (no delete)."""

    buckets: int
    keys: tuple[str, ...]
    sequence: str
    tiebreak: tuple[str, ...]
    visible: str

    @classmethod
    def open(cls, spark: SparkSession, root: str, e: Entity, buckets: int | None = None) -> SpliceStore:
        """The store below ``root``; a new one gets ``buckets``, by default one per shuffle partition."""
        there = _glob(spark, f"{root}/buckets=*")
        n = int(there[0].rsplit("=", 1)[1]) if there else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls(spark, f"{root}/buckets={n}", n, e.keys, e.sequence, e.tiebreak, f"NOT coalesce({e.delete_when}, false)")

    # runs ------------------------------------------------------------------
    def _read(self, spans: Sequence[tuple[int, int]], schema) -> DataFrame:
        paths = [p for s in spans for p in _glob(self.spark, f"{self._path(s)}/_bucket=*")]
        if not paths:
            return self.spark.createDataFrame([], schema)
        parts = [self.spark.read.schema(schema).option("basePath", self._path(s)).parquet(self._path(s)) for s in spans
                 if _glob(self.spark, f"{self._path(s)}/_bucket=*")]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _write(self, rows: DataFrame, span: tuple[int, int], dealt: bool = False) -> None:
        """A run: buckets as folders, a large bucket over several tasks, closed intervals first in every file.  Rows that
        are ``dealt`` out by bucket already are not moved again."""
        placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        (placed if dealt else placed.hint("rebalance", "_bucket")).sortWithinPartitions("_bucket", F.asc_nulls_last(END), *self.keys) \
            .write.mode("overwrite").option("compression", CODEC).partitionBy("_bucket").parquet(self._path(span))

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, [*self.keys, START], [AT])

    # a batch ---------------------------------------------------------------
    def _stored(self, changes: DataFrame, batch_id: int, schema) -> DataFrame | None:
        """Rows of the stored intervals in the buckets and between the first and last time of ``changes``, old ones
        included; None while nothing is stored."""
        spans = self.runs(before=batch_id)
        if not spans:
            return None
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        lo, hi, buckets = changes.agg(F.min(self.sequence), F.max(self.sequence), F.collect_set(bucket)).first()
        kind = changes.schema[self.sequence].dataType       # two times and at most ``buckets`` numbers
        return self._read(spans, schema).where(
            F.col("_bucket").isin(buckets) & (F.col(START).isNull() | (F.col(START) <= F.lit(hi).cast(kind)))
            & (F.col(END).isNull() | (F.col(END) > F.lit(lo).cast(kind))))

    def near(self, changes: DataFrame, batch_id: int, schema) -> DataFrame:
        """Newest rows of the stored intervals that may hold a time of ``changes``: of the same key, and
        between the key's first and last time in the batch."""
        stored = self._stored(changes, batch_id, schema)
        if stored is None:
            return self.spark.createDataFrame([], schema)
        mine = changes.groupBy(*self.keys).agg(F.min(self.sequence).alias("_lo"), F.max(self.sequence).alias("_hi"))
        inside = (F.col(START).isNull() | (F.col(START) <= F.col("_hi"))) & (F.col(END).isNull() | (F.col(END) > F.col("_lo")))
        return self._newest(stored.join(mine, list(self.keys)).where(inside)).drop("_bucket", "_lo", "_hi")

    def _hot(self, changes: DataFrame, n: int, batch_id: int, schema, hot_rows: int, chunk_rows: int = CHUNK_ROWS,
             fraction: float = SAMPLE_FRACTION) -> bool:
        """Whether a key may have more than ``hot_rows`` rows among the ``n`` changes and the stored rows near them."""
        spans = self.runs(before=batch_id)
        if n + (self._read(spans, schema).count() if spans else 0) <= hot_rows:
            return False
        rows, stored = changes.select(*self.keys, self.sequence), self._stored(changes, batch_id, schema)
        if stored is not None:
            rows = rows.unionByName(stored.select(*self.keys, F.col(START).alias(self.sequence)))
        return not hot_keys(rows, self.keys, self.sequence, hot_rows, chunk_rows, fraction).isEmpty()

    def apply(self, changes: DataFrame, batch_id: int, deltas: bool = False, hot_rows: int = HOT_KEY_ROWS, **hot) -> DataFrame | None:
        """Splice a batch of changes into the store.  With ``deltas`` the signed change of the current versions is
        kept with the batch and returned: rows that became current (``_sign`` 1) and rows that no longer are (-1)."""
        self._merge(batch_id)
        known = F.assert_true(F.col(self.sequence).isNotNull(), F.lit(f"{self.sequence} is NULL")).isNull()
        new = changes.where(known).withColumns({START: F.col(self.sequence), ROOT: F.lit(False), AT: F.lit(batch_id).cast("long")})
        new, n = materialize(latest_per_key(new, [*self.keys, START], self.tiebreak or [AT]), "splice_new")
        if not n:
            return None
        schema = new.withColumn(END, F.lit(None).cast(new.schema[START].dataType)).withColumn("_bucket", F.lit(0)).schema
        columns = [c for c in schema.names if c != "_bucket"]
        row = F.struct(*columns)
        empty = F.lit(None).cast(self.spark.createDataFrame([], schema).select(row.alias("r")).schema["r"].dataType)
        at = [*self.keys, START]
        # a slot is part of a bucket: dealt out once by slot, rows need no other shuffle until they lie in their bucket's files
        slots = -(-_partitions(new, None) // self.buckets)
        place = F.xxhash64(*self.keys)
        slot = (F.pmod(place, F.lit(self.buckets)) + self.buckets * F.pmod(F.shiftright(place, 32), F.lit(slots))).cast("int")
        both = self.near(new, batch_id, schema).select(*at, row.alias("_old"), empty.alias("_new")) \
            .unionByName(new.withColumn(END, F.lit(None).cast(new.schema[START].dataType)).select(*at, empty.alias("_old"), row.alias("_new")))
        calm = not self._hot(new, n, batch_id, schema, hot_rows, **hot)
        if calm:
            both = both.withColumn("_slot", slot).repartition(self.buckets * slots, "_slot")
            at = ["_slot", *at]
        # of a stored and a new change at one time the later by tie-break stays; it has the stored one's interval
        pairs = both.groupBy(*at).agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("_old", "_new")))
        tie = {c: F.struct(F.lit(0).alias("_"), *(F.col(f"{c}.{t}") for t in self.tiebreak)) for c in ("_old", "_new")}
        wins = F.col("_new").isNotNull() & (F.col("_old").isNull() | (tie["_old"] < tie["_new"] if self.tiebreak else F.lit(True)))
        pairs = pairs.withColumns({
            "_wins": wins, "_until": F.when(F.col("_old").isNotNull(), F.struct(F.col(f"_old.{END}").alias("at"))),
            "_self": F.struct(F.col(START).alias("at"), (wins & F.col("_old").isNull()).alias("splits"))})
        if calm:
            by_key = Window.partitionBy("_slot", *self.keys).orderBy(START)
            pairs = pairs.withColumns({
                "_inside": F.last("_until", ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, 0)),
                "_next": F.lead("_self").over(by_key),
                "_head": F.row_number().over(by_key) == 1})
        else:
            pairs = keyed_carry(cut_lineage(pairs, "splice_pairs"), self.keys, [START], "_until", "_inside", hot_rows, **hot)
            pairs = range_lead(pairs, self.keys, [START], "_self", "_next", hot_rows, **hot)
        end = F.col(f"_old.{END}")
        shortened = ~F.col("_wins") & F.coalesce(F.col("_next.splits"), F.lit(False)) & (end.isNull() | (F.col("_next.at") < end))
        spliced = pairs.where(F.col("_wins") | shortened).select(
            *at, "_old", "_new", "_wins", F.col("_inside").isNull().alias("_unseen"),
            F.least("_inside.at", "_next.at").alias("_end"), *(["_head"] if calm else []))
        if deltas or not calm:
            spliced = cut_lineage(spliced, "spliced")

        def spliced_row(which: str):
            return F.struct(*(F.lit(batch_id).cast("long").alias(c) if c == AT else F.col("_end").alias(c) if c == END
                              else F.col(f"{which}.{c}").alias(c) for c in columns))

        root = F.struct(*(F.lit(batch_id).cast("long").alias(c) if c == AT else F.lit(True).alias(c) if c == ROOT
                          else F.col(START).alias(c) if c == END else F.col(c) if c in self.keys
                          else F.lit(None).cast(schema[c].dataType).alias(c) for c in columns))
        rows = F.when(~F.col("_wins"), F.array(spliced_row("_old"))).when(F.col("_first"), F.array(root, spliced_row("_new"))) \
            .otherwise(F.array(spliced_row("_new")))
        if calm:                                            # what no stored interval holds comes before all that one holds
            marked = spliced.withColumn("_first", F.col("_unseen") & F.col("_head"))
        else:
            earliest = spliced.where("_unseen").groupBy(*self.keys).agg(F.min(START).alias("_earliest"))
            marked = _join_keys(spliced, earliest, self.keys, "left") \
                .withColumn("_first", F.coalesce(F.col("_unseen") & (F.col(START) == F.col("_earliest")), F.lit(False)))
        self._write(marked.select(F.explode(rows).alias("r")).select("r.*"), (batch_id, batch_id), dealt=calm and not deltas)
        if not deltas:
            return None
        shown = F.expr(self.visible) & ~F.col(ROOT) & F.col(END).isNull()
        kept = [*changes.columns, START]
        now = spliced.where("_wins").select(spliced_row("_new").alias("r")).select("r.*").where(shown)
        gone = spliced.where("_old IS NOT NULL").select("_old.*").where(shown)
        path = f"{self.root}/deltas/batch={batch_id}"
        now.select(*kept, F.lit(1).alias("_sign")).unionByName(gone.select(*kept, F.lit(-1).alias("_sign"))) \
            .write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.parquet(path)

    def _combine(self, live: list[tuple[int, int]], span: tuple[int, int]) -> None:
        some = next((p for s in live for p in _glob(self.spark, f"{self._path(s)}/_bucket=*")), None)
        if some:
            schema = self.spark.read.option("basePath", some.rsplit("/", 1)[0]).parquet(some).schema
            self._write(self._newest(self._read(live, schema)).drop("_bucket"), span)

    # reading ---------------------------------------------------------------
    def versions(self, empty: DataFrame) -> DataFrame:
        """All versions, with start and end; ``empty`` (no rows, its columns) while no batch had a clean change."""
        spans = self.runs()
        some = [p for s in spans for p in _glob(self.spark, f"{self._path(s)}/_bucket=*")]
        if not some:
            return empty
        schema = self.spark.read.option("basePath", some[0].rsplit("/", 1)[0]).parquet(some[0]).schema
        rows = self._read(spans, schema)
        rows = self._newest(rows) if len(spans) > 1 else rows
        return rows.where(F.expr(self.visible) & ~F.col(ROOT)).select(*empty.columns)

    def current(self, empty: DataFrame) -> DataFrame:
        """The version that is open, of each key that has one."""
        return self.versions(empty.withColumn(END, F.lit(None)) if END not in empty.columns else empty) \
            .where(F.col(END).isNull()).select(*empty.columns)
