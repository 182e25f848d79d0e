"""Substring dedup on a compacted De Bruijn graph of token k-mers.

A k-mer of ``window`` (35) words is an edge from the node of its first 34 words to the node
of its last 34.  A word goes if some k-mer over it also starts anywhere else.

1. Super-k-mers.  Consecutive k-mers of a text with the same minimizer (the least hash among
   their ``SEED``-word subsequences) form one run.  Equal k-mers have equal minimizers, so a
   k-mer can repeat only if its run's minimizer does.  Minimizers are counted, and only runs
   of repeated ones go on.
2. A run carries its source coordinate (document, first word) and a digest of its very
   words.  Runs with the same digest are copies: their digests verify them, whatever the hashes.
3. A run without a copy may still share k-mers with others at the end of a repeated
   passage.  Its k-mers are counted one by one (128-bit keys) among the runs with its minimizer.
4. Compaction.  Repeated runs are edges between their first and last nodes.  Where one run
   enters a node and one leaves it, they are linked, and pointer doubling by joins gives each
   run its path and its place on it; a path's source is its first run's first coordinate.
   The paths are a report: no word goes or stays by them.
5. Counting decides: occurrences of whole copies, and the repeated k-mers of the other runs, become the
   words' ranges in each document. Partly repeated runs are not edges of the graph.

The minimizers that matter reach the text passes as a bitmap of fixed size; where it lets too
much through, the exact joins behind it decide.  Joins and counts are on digests or hashes, with
map-side sums, and a document's ranges are gathered for that document only.

Null and empty texts have no words; texts below 35 words have no k-mer.  Repeated rows count
as separate documents: each is a copy of the other, and both lose their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, Scratch, bitmap, in_bitmap, let, named, others, packed, sha, table
from tessera.llm.tokens import SPACE_WORD, WORD_BASE, Rolling, Words, find_words, mix, slices

WINDOW = 35
SEED = 12                       # words of a minimizer
RUN = 48                        # k-mers of a run at most, so that a long holds one bit for each
OTHER_BASE = 0xA0761D6478BD642F
U64 = np.uint64


def _sliding(best: np.ufunc, a: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) of each ``width`` consecutive values, by doubling."""
    out, span = a, 1
    while span * 2 <= width:
        out = best(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return best(out[:len(out) - rest], out[rest:]) if rest else out


@dataclass
class Runs:
    """Super-k-mer runs of a slice of texts."""
    words: Words
    roll: Rolling | None
    row: np.ndarray             # text
    start: np.ndarray           # first word of the run, counted over the slice
    length: np.ndarray          # k-mers
    minimizer: np.ndarray       # int64
    chosen: np.ndarray          # int64: the minimizer of every place that some k-mer takes it from


def runs_of(rows: pa.RecordBatch, text: int, window: int) -> Runs:
    words = find_words(rows.column(text), SPACE_WORD)
    at, _ = words.windows(window)
    empty = np.zeros(0, np.int64)
    if not len(at):
        return Runs(words, None, empty, empty, empty, empty, empty)
    roll = Rolling(words.hashes(), WORD_BASE)
    seed = min(SEED, window)
    i = np.arange(len(words) - seed + 1)
    hashes, width = roll.of(i, i + seed), window - seed + 1
    least = _sliding(np.minimum, hashes, width)[at]
    by_kmer = np.zeros(len(hashes) + width - 1, np.uint64)
    by_kmer[at + width - 1] = least
    chosen = hashes[_sliding(np.maximum, by_kmer, width) == hashes]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at)))
    parts = -(-length // RUN)                               # runs of equal minimizers may be long: cut them
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first, length = np.repeat(first, parts) + nth * RUN, np.minimum(np.repeat(length, parts) - nth * RUN, RUN)
    start = at[first]
    row = np.searchsorted(words.first, start, "right") - 1
    return Runs(words, roll, row, start, length, least[first].view(np.int64), chosen.view(np.int64))


def _digests(r: Runs, which: np.ndarray, window: int) -> list[bytes]:
    """Digest of each run's words, joined by one space."""
    a = r.words.start[r.start[which]].tolist()
    b = r.words.end[r.start[which] + r.length[which] + window - 2].tolist()
    raw = r.words.data.tobytes()
    return [hashlib.blake2b(b" ".join(raw[x:y].split()), digest_size=16).digest() for x, y in zip(a, b)]


def _count_minimizers(window: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            m, n = np.unique(runs_of(rows, 0, window).chosen, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()), pa.array(n, pa.int64())], names=["minimizer", "n"])
    return count


def _emit_runs(window: int, shared):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for rows in slices(batches, "text"):
            r = runs_of(rows, 2, window)
            which = np.flatnonzero(in_bitmap(bits, r.minimizer))
            row = pa.array(r.row[which])
            nodes = [np.zeros(0, np.int64)] * 2
            if len(which):
                a, b = r.start[which], r.start[which] + r.length[which]
                nodes = [mix(r.roll.of(x, x + window - 1)).view(np.int64) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(row), rows.column(1).take(row),
                 pa.array((r.start - r.words.first[r.row])[which], pa.int64()), pa.array(r.length[which], pa.int32()),
                 pa.array(r.minimizer[which]), pa.array(_digests(r, which, window) if len(which) else [], pa.binary()),
                 pa.array(nodes[0]), pa.array(nodes[1])],
                names=["id", "text_hash", "start", "length", "minimizer", "digest", "enters", "leaves"])
    return emit


def _emit_kmers(window: int, shared):
    """Digest and k-mer keys of the runs in the bitmap, each digest once a slice."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for rows in slices(batches, "text"):
            r = runs_of(rows, 0, window)
            which = np.flatnonzero(in_bitmap(bits, r.minimizer))
            digest, one, two = [], [], []
            if len(which):
                other = Rolling(r.words.hashes(), OTHER_BASE)
                seen = {}
                for d, i in zip(_digests(r, which, window), which.tolist()):
                    seen.setdefault(d, i)
                for d, i in seen.items():
                    at = np.arange(r.start[i], r.start[i] + r.length[i])
                    digest.append(d)
                    one.append(r.roll.of(at, at + window).view(np.int64))
                    two.append(other.of(at, at + window).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), pa.array(one, pa.list_(pa.int64())), pa.array(two, pa.list_(pa.int64()))],
                names=["digest", "one", "two"])
    return emit


@dataclass
class Repeats:
    """``spans``: id, text_hash, spans (disjoint word ranges [start, end) to remove), by distinct document.
    ``paths``: path, runs, kmers, id, start (the path's source coordinate), copies of its first run."""
    spans: DataFrame
    paths: DataFrame
    scratch: Scratch


def find_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> Repeats:
    spark = docs.sparkSession
    scratch = Scratch(spark, "debruijn")
    source = docs.select(named(doc_id).alias("id"), F.xxhash64(named(text)).alias("text_hash"), named(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    broadcast = spark.sparkContext.broadcast

    counted = source.select("text").mapInArrow(_count_minimizers(window), "minimizer long, n long")
    repeated = counted.groupBy("minimizer").agg(F.sum("n").alias("n")).where("n > 1")
    wanted = broadcast(bitmap(repeated, "minimizer"))
    runs = source.mapInArrow(
        _emit_runs(window, wanted),
        f"id {kind}, text_hash long, start long, length int, minimizer long, digest binary, enters long, leaves long")
    runs = scratch.write(runs, "runs")
    wanted.unpersist()
    distinct = scratch.write(runs.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.first("minimizer").alias("minimizer"), F.first("length").alias("length"),
        F.first("enters").alias("enters"), F.first("leaves").alias("leaves"),
        F.min(F.struct("id", "start")).alias("source")).withColumn("run", F.monotonically_increasing_id()), "distinct")

    alone = distinct.where("copies = 1")
    wanted = broadcast(bitmap(alone, "minimizer"))
    kmers = source.select("text").mapInArrow(_emit_kmers(window, wanted), "digest binary, one array<long>, two array<long>")
    kmers = kmers.groupBy("digest").agg(F.first("one").alias("one"), F.first("two").alias("two"))
    kmers = scratch.write(kmers.join(distinct.select("digest", "copies"), "digest"), "kmers")
    wanted.unpersist()
    each = kmers.select("digest", "copies", F.posexplode(F.arrays_zip("one", "two")).alias("place", "key")) \
        .select("digest", "copies", "place", "key.one", "key.two")
    again = each.groupBy("one", "two").agg(F.sum("copies").alias("n")).where("n > 1").select("one", "two")
    partly = each.where("copies = 1").join(again, ["one", "two"]).groupBy("digest") \
        .agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("mask"))

    paths = compact(distinct.where("copies > 1"), scratch)
    judged = distinct.join(paths.select("run", "path"), "run", "left").join(partly, "digest", "left") \
        .where("copies > 1 or mask is not null").select("digest", "copies", "mask", "path")
    found = runs.join(judged, "digest")
    whole = F.array(F.struct(F.col("start").alias("s"), (F.col("start") + F.col("length") + (window - 1)).alias("e")))
    bit = F.filter(F.sequence(F.lit(0), F.col("length") - 1),
                   lambda i: F.call_function("shiftright", F.col("mask"), i).bitwiseAND(F.lit(1)) == 1)
    pieces = F.transform(bit, lambda i: F.struct((F.col("start") + i).alias("s"), (F.col("start") + i + window).alias("e")))
    ranges = found.select("id", "text_hash", F.explode(F.when(F.col("copies") > 1, whole).otherwise(pieces)).alias("r")) \
        .select("id", "text_hash", "r.s", "r.e").distinct()
    spans = scratch.write(_merged(ranges), "spans")
    listed = distinct.where("copies > 1").join(paths, "run").groupBy("path").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("length").alias("kmers"),
        F.min_by(F.struct("source", "copies"), "place").alias("head"))
    listed = scratch.write(listed.select("path", "runs", "kmers", "head.source.id", "head.source.start", "head.copies"), "paths")
    scratch.drop("runs", "distinct", "kmers", "compacted")
    return Repeats(spans, listed, scratch)


def _merged(ranges: DataFrame) -> DataFrame:
    """Ranges (id, text_hash, s, e) of each document as one sorted array of disjoint ranges."""
    doc = Window.partitionBy("id", "text_hash").orderBy("s", "e")
    before = F.max("e").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (before < F.col("s"))).cast("int")
    island = F.sum("opens").over(doc.rowsBetween(Window.unboundedPreceding, 0))
    return ranges.withColumn("opens", opens).withColumn("island", island) \
        .groupBy("id", "text_hash", "island").agg(F.min("s").alias("start"), F.max("e").alias("end")) \
        .groupBy("id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def compact(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(run, path, place) of edges (run, enters, leaves): maximal paths through nonbranching nodes.

    A node with exactly one edge in and one out links the two.  Pointer doubling then
    follows the links backwards: after round r an edge knows the edge 2^r places before it.
    The path is named by its first edge; on a cycle, where no edge is first, every edge ends
    as its own path after the doubling has passed the number of edges."""
    into = edges.groupBy(F.col("leaves").alias("node")).agg(F.count(F.lit(1)).alias("ins"), F.first("run").alias("before"))
    out = edges.groupBy(F.col("enters").alias("node")).agg(F.count(F.lit(1)).alias("outs"), F.first("run").alias("run"))
    links = into.where("ins = 1").join(out.where("outs = 1"), "node").where("before != run").select("run", "before")
    state = scratch.write(edges.select("run").join(links, "run", "left")
                          .select("run", F.coalesce("before", "run").alias("back"),
                                  F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("place")), "jump0")
    n, k = state.count(), 0
    while True:
        step = state.select(F.col("run").alias("back"), F.col("back").alias("further"), F.col("place").alias("more"))
        moved = state.select("run", "back", "place").join(step, "back").select("run", F.col("further").alias("back"),
                                                (F.col("place") + F.col("more")).alias("place"), "more")
        k += 1
        state = scratch.write(moved, f"jump{k}")
        going = state.where("more > 0").limit(1).count()
        scratch.drop(f"jump{k - 1}")
        if not going:
            break
        if (1 << k) > n:                                    # only cycles are left
            cycle = F.col("more") > 0
            state = state.select("run", F.when(cycle, F.col("run")).otherwise(F.col("back")).alias("back"),
                                 F.when(cycle, F.lit(0)).otherwise(F.col("place")).cast("long").alias("place"))
            break
    out = scratch.write(state.select("run", F.col("back").alias("path"), "place"), "compacted")
    scratch.drop(f"jump{k}")
    return out


def _words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _outside(words: Column, spans: Column) -> Column:
    """The words outside sorted, disjoint spans: the slices between them."""
    def gap(i: Column, w: Column) -> Column:
        a = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.try_element_at(spans, i)["end"])
        b = F.when(i == F.size(spans), F.size(w).cast("long")).otherwise(F.try_element_at(spans, i + 1)["start"])
        return F.slice(w, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))

    return let(words, lambda w: F.flatten(F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: gap(i, w))))


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   kept: str = "kept_words", n_words: str = "n_words", n_removed: str = "n_removed") -> DataFrame:
    """``docs`` with the kept words (array), the number of words and of removed words (old columns of these names go)."""
    spans = find_repeats(docs, doc_id=doc_id, text=text, window=window).spans
    rows = packed(docs, others(docs, (kept, n_words, n_removed)), id=doc_id, text=text) \
        .withColumn("text_hash", F.xxhash64("text"))
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.text_hash") == F.col("r.text_hash"))
    joined = rows.alias("l").join(spans.alias("r"), same, "left") \
        .select("l.row", _words(F.col("l.text")).alias("words"), "r.spans")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    stay = F.when(F.col("spans").isNull(), F.col("words")).otherwise(_outside(F.col("words"), F.col("spans")))
    out = joined.select("row", F.size("words").cast("long").alias(n_words),
                        F.coalesce(removed, F.lit(0)).cast("long").alias(n_removed), stay.alias(kept))
    return out.select("row.*", named(n_words), named(n_removed), named(kept))


def op3_debruijn(spark, sf_dir: str) -> DataFrame:
    """Words of every document outside passages of 35 words that repeat anywhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed",
                                       sha(F.array_join("kept_words", " ")).alias("kept_sha256"))
