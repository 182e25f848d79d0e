"""Reversible incremental line dedup: sharded cuckoo filters over exact reference counts.

``LineIndex`` keeps, for every line key, the exact number of documents that hold it
(``counts``: shard, key, documents) and, per shard, a cuckoo filter of the keys that have
reached the limit.  Adding documents raises counts, deleting documents lowers them; keys
that cross the limit go into or out of their shard's filter.  A cuckoo filter can delete,
so taking documents away brings their lines back everywhere else.

Dropping lines probes the filters first: a line that is in no filter is surely kept and goes
no further.  The few others are checked against the exact counts by a join, so a filter's
false positives never reach the result.  While the filters' total size is below ``FILTER_BYTES`` they ship
to the tasks; beyond it the lines go to their shard's filter, spread over ``SPREAD`` tasks a shard, so
that neither the driver nor one task meets all filters or all copies of a frequent line.

The number of shards doubles when an addition fills them to more than ``shard_keys`` live keys on average;
the filters are then built anew from the exact counts.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased.  Counts
are by 128-bit digest of the key.  A null or empty text is one empty line; empty keys are
never dropped.  A document counts once for each key, however often it repeats the line;
repeated rows count as separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, Scratch, free_name, let, lower_az, named, others, sha, table

MIN_DOCUMENTS = 10
SHARD_KEYS = 1 << 19                # keys of a shard at most, on average: bounds one shard's task
FILTER_BYTES = 64 << 20
SPREAD = 16                         # tasks that a shard's lines are spread over when they go to its filter
SLOTS, KICKS, LOAD = 4, 500, 0.85


class CuckooFilter:
    """Cuckoo filter of 64-bit hashes: 16-bit fingerprints in buckets of four, with deletion."""

    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), np.uint16)      # a power of two buckets; 0 is free

    @staticmethod
    def buckets_for(keys: int) -> int:
        return 1 << max(2, int(max(keys, 1) / (SLOTS * LOAD)).bit_length())

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = np.asarray(h, np.uint64)
        fp = (h >> np.uint64(48)).astype(np.uint16)
        fp = np.where(fp == 0, 1, fp).astype(np.uint16)
        one = (h & np.uint64(len(self.table) - 1)).astype(np.int64)
        return fp, one, self._other(one, fp)

    def _other(self, place, fp):
        return place ^ ((np.asarray(fp, np.int64) * 0x5BD1E995) & (len(self.table) - 1))

    def has(self, h: np.ndarray) -> np.ndarray:
        fp, one, two = self._places(h)
        return ((self.table[one] == fp[:, None]) | (self.table[two] == fp[:, None])).any(1)

    def add(self, h: np.ndarray) -> bool:
        """False if a key found no place: the caller builds a larger filter."""
        rng = np.random.default_rng(len(self.table))
        for fp, one, two in zip(*(x.tolist() for x in self._places(h))):
            for place in (one, two):
                free = np.flatnonzero(self.table[place] == 0)
                if len(free):
                    self.table[place, free[0]] = fp
                    break
            else:
                place = two
                for _ in range(KICKS):
                    out = int(rng.integers(SLOTS))
                    fp, self.table[place, out] = int(self.table[place, out]), fp
                    place = int(self._other(place, fp))
                    free = np.flatnonzero(self.table[place] == 0)
                    if len(free):
                        self.table[place, free[0]] = fp
                        break
                else:
                    return False
        return True

    def remove(self, h: np.ndarray) -> None:
        for fp, one, two in zip(*(x.tolist() for x in self._places(h))):
            for place in (one, two):
                at = np.flatnonzero(self.table[place] == fp)
                if len(at):
                    self.table[place, at[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        f = cls(1)
        f.table = np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy()
        return f


def updated(raw: bytes | None, stay: np.ndarray, gone: np.ndarray, new: np.ndarray) -> CuckooFilter:
    """A shard's filter after ``gone`` keys leave and ``new`` keys enter; ``stay`` is all that it holds then.

    It is changed in place while the keys fit, and built anew from ``stay`` in twice the size otherwise."""
    if raw is not None:
        f = CuckooFilter.from_bytes(raw)
        f.remove(gone)
        if len(stay) <= f.table.size * LOAD and f.add(new):
            return f
    buckets = CuckooFilter.buckets_for(len(stay))
    while True:
        f = CuckooFilter(buckets)
        if f.add(stay):
            return f
        buckets *= 2


def line_keys(text: Column) -> Column:
    """Digest of each line's key, in line order; null for an empty key."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)

    def digest(line: Column) -> Column:
        key = lower_az(F.btrim(line, F.lit(SPACES)))
        return F.when(key != "", F.unhex(F.md5(key.cast("binary"))))

    return F.transform(lines, digest)


def _hash64(keys) -> np.ndarray:
    """The first eight bytes of each 16-byte digest."""
    return np.frombuffer(b"".join(bytes(k) for k in keys), np.uint64)[::2] if len(keys) else np.zeros(0, np.uint64)


class LineIndex:
    """Exact counts and cuckoo filters in the shared folder; every change writes a new generation."""

    def __init__(self, spark: SparkSession, min_documents: int = MIN_DOCUMENTS, shard_keys: int = SHARD_KEYS):
        self.spark, self.min_documents, self.shard_keys = spark, min_documents, shard_keys
        self.scratch, self.generation, self.shards = Scratch(spark, "lines"), 0, 0
        self.counts: DataFrame | None = None        # key, documents (at least 1)
        self.filters: DataFrame | None = None       # shard, filter

    def _document_keys(self, docs: DataFrame, text: str) -> DataFrame:
        distinct = F.array_distinct(F.filter(line_keys(F.col(text)), lambda k: k.isNotNull()))
        return docs.select(F.explode(distinct).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("by"))

    def _shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.shards)).cast("int")

    def add(self, docs: DataFrame, text: str = "text") -> None:
        self._change(self._document_keys(docs, text))

    def delete(self, docs: DataFrame, text: str = "text") -> None:
        """Takes away documents that were added; a key's count never goes below zero."""
        self._change(self._document_keys(docs, text).withColumn("by", -F.col("by")))

    def _change(self, by: DataFrame) -> None:
        self.generation += 1
        g = self.generation
        if self.counts is None:
            merged = by.select("key", F.lit(0).cast("long").alias("before"), F.col("by").alias("documents"))
        else:
            merged = self.counts.join(by, "key", "full").select(
                "key", F.coalesce("documents", F.lit(0)).cast("long").alias("before"),
                (F.coalesce("documents", F.lit(0)) + F.coalesce("by", F.lit(0))).alias("documents"))
        merged = self.scratch.write(merged, f"merged{g}")
        old, had = self.filters, self.shards
        live = merged.where("documents > 0")
        self.shards, n = max(1, had), live.count()
        while n > self.shards * self.shard_keys:
            self.shards *= 2
        counts = self.scratch.write(live.select("key", "documents"), f"counts{g}")
        limit = self.min_documents
        inside, was = F.col("documents") >= limit, F.col("before") >= limit
        moved = merged.where(inside | was).select(self._shard(F.col("key")).alias("shard"), "key",
                                                  inside.alias("inside"), was.alias("was"))
        if old is None or had != self.shards:
            moved = moved.withColumn("filter", F.lit(None).cast("binary"))
            built = moved.groupBy("shard").applyInPandas(_rebuild, "shard int, filter binary")
        else:
            filters = old
            built = moved.groupBy("shard").cogroup(filters.groupBy("shard")) \
                .applyInPandas(_update, "shard int, filter binary")
        self.filters = self.scratch.write(built, f"filters{g}")
        self.counts = counts
        self.scratch.drop(f"merged{g}", *([f"counts{g - 1}", f"filters{g - 1}"] if g > 1 else []))

    def frequent(self) -> DataFrame:
        """Keys whose lines are dropped, by the exact counts."""
        return self.counts.where(F.col("documents") >= self.min_documents).select("key")

    def lines_to_drop(self, docs: DataFrame) -> DataFrame:
        """``doc`` and ``drop`` (array of line numbers from 0) of the documents (doc, text) that lose lines."""
        lines = docs.select("doc", line_keys(F.col("text")).alias("line_keys"))
        if self.scratch.bytes(f"filters{self.generation}") <= FILTER_BYTES:
            found = self._probe(lines)
        else:
            found = self._probe_by_shard(lines)
        return found.join(self.frequent(), "key").groupBy("doc").agg(F.collect_set("line").alias("drop"))

    def _probe_by_shard(self, lines: DataFrame) -> DataFrame:
        """The lines whose shard's filter has their key: lines and filters meet by shard and part.  A part is
        picked by the document too, so a line of very many documents is in all parts of its shard."""
        rows = lines.select("doc", F.posexplode("line_keys").alias("line", "key")).where("key is not null") \
            .select("doc", "line", "key", self._shard(F.col("key")).alias("shard"),
                    F.pmod(F.xxhash64("doc", "line"), F.lit(SPREAD)).cast("int").alias("part"))
        kind = lines.select("doc", F.lit(0).alias("line"), F.lit(b"").alias("key")).schema
        filters = self.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        return _tagged(rows, filters).mapInArrow(_probe_sorted, kind)

    def _probe(self, lines: DataFrame) -> DataFrame:
        shared = self.spark.sparkContext.broadcast(
            {r["shard"]: bytes(r["filter"]) for r in self.filters.toLocalIterator()})
        shards = self.shards
        schema = lines.select("doc", F.lit(0).alias("line"), F.lit(b"").alias("key")).schema
        with_shards = lines.withColumn("line_shards", F.transform("line_keys", lambda k: self._shard(k)))

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = {s: CuckooFilter.from_bytes(raw) for s, raw in shared.value.items()}
            for b in batches:
                col = lambda name: b.column(b.schema.get_field_index(name))
                lists, shard = col("line_keys"), col("line_shards").flatten().fill_null(-1).to_numpy()
                flat = lists.flatten()
                n = np.asarray(lists.value_lengths().fill_null(0))
                row = np.repeat(np.arange(len(n)), n)
                line = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                real = np.flatnonzero(np.asarray(flat.is_valid()))
                h = _hash64(flat.take(pa.array(real)).to_pylist())
                maybe = np.zeros(len(real), bool)
                for s, f in filters.items():
                    own = shard[real] == s if shards > 1 else np.ones(len(real), bool)
                    maybe[own] = f.has(h[own])
                hit = real[maybe]
                rows = pa.array(row[hit])
                yield pa.RecordBatch.from_arrays(
                    [col("doc").take(rows), pa.array(line[hit].astype(np.int32)), flat.take(pa.array(hit))],
                    names=["doc", "line", "key"])

        return with_shards.mapInArrow(probe, schema)


def _tagged(rows: DataFrame, filters: DataFrame) -> DataFrame:
    """Lines and filters in one table, partitioned by shard and part, a shard's filter before its lines."""
    null = F.lit(None)
    kinds = dict((f.name, f.dataType) for f in rows.schema)
    both = rows.withColumn("filter", null.cast("binary")).union(filters.select(
        *(null.cast(kinds[c]).alias(c) for c in ("doc", "line", "key")), "shard", "part", "filter"))
    return both.repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("filter").isNull()) \
        .select("doc", "line", "key", "shard", "filter")


def _probe_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One filter is held at a time, however many lines follow it."""
    own, held = None, None
    for b in batches:
        col = lambda name: b.column(b.schema.get_field_index(name))  # noqa: E731,B023
        shard, heads = col("shard").to_numpy(), np.flatnonzero(np.asarray(col("filter").is_valid()))
        cuts = np.union1d(np.concatenate([[0], heads, heads + 1]), np.flatnonzero(np.diff(shard)) + 1)
        hit = [np.zeros(0, np.int64)]
        for lo, hi in zip(cuts, [*cuts[1:], len(shard)]):
            if lo >= len(shard):
                continue
            raw = col("filter")[int(lo)].as_py()
            if raw is not None:
                own, held = shard[lo], CuckooFilter.from_bytes(raw)
            elif own == shard[lo]:                          # a shard without a filter has no frequent key
                at = np.arange(lo, hi)
                hit.append(at[held.has(_hash64(col("key").take(pa.array(at)).to_pylist()))])
        rows = pa.array(np.concatenate(hit))
        yield pa.RecordBatch.from_arrays([col(c).take(rows) for c in ("doc", "line", "key")], names=["doc", "line", "key"])


def _rebuild(keys: pd.DataFrame) -> pd.DataFrame:
    return _update(keys, pd.DataFrame({"shard": [], "filter": []}))


def _update(keys: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    if not len(keys):
        return old[["shard", "filter"]]
    inside, was = keys["inside"].to_numpy(bool), keys["was"].to_numpy(bool)
    h = _hash64(keys["key"].tolist())
    raw = bytes(old["filter"].iloc[0]) if len(old) else None
    f = updated(raw, h[inside], h[was & ~inside], h[inside & ~was])
    return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "filter": [f.to_bytes()]})


def drop_lines(docs: DataFrame, index: LineIndex, text: str = "text", kept: str = "kept_text",
               n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the text without its frequent lines, the number of lines, and of dropped lines
    (old columns of these names go).

    Rows find their lines again by all their columns of simple types but the text, and a hash of
    the text; rows equal in all of them lose the same lines."""
    plain = [c for c, kind in docs.dtypes if c != text and not kind.startswith(("map", "array", "struct", "variant", "interval"))]
    doc = F.struct(*(named(c) for c in plain), F.xxhash64(named(text)).alias(free_name(plain, "text_hash")))
    row = F.struct(*(named(c) for c in others(docs, (kept, n_lines, n_dropped))))
    left = docs.select(doc.alias("doc"), row.alias("row"), named(text).alias("text"))
    drops = index.lines_to_drop(left.select("doc", "text"))
    lines = F.split(F.coalesce(F.col("l.text"), F.lit("")), "\n", -1)
    drop = F.col("r.drop")
    stay = F.when(drop.isNull(), lines).otherwise(let(lines, lambda ls: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), drop), lambda i: ls[i])))
    joined = left.alias("l").join(drops.alias("r"), F.col("l.doc").eqNullSafe(F.col("r.doc")), "left").select(
        F.col("l.row").alias("row"), F.array_join(stay, "\n").alias(kept), F.size(lines).cast("long").alias(n_lines),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias(n_dropped))
    return joined.select("row.*", named(kept), named(n_lines), named(n_dropped))


def op7_cuckoo_lines(spark, sf_dir: str) -> DataFrame:
    """Lines whose key is in at least ten documents leave every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = LineIndex(spark)
    index.add(docs)
    return drop_lines(docs, index).select("doc_id", "n_lines", "n_dropped", sha(F.col("kept_text")).alias("kept_sha256"))
