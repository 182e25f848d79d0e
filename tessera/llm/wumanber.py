"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every window of ``size`` consecutive words of a benchmark item (a shorter item is one
window) is a pattern; patterns of one length form a searcher:

* a shift table, indexed by the hash of a block of two words, says how far the search may
  jump: the least distance of that block from the end of any pattern, or past the block
  when no pattern has it;
* where the shift is 0, the hash of the suffix block selects the bucket of test patterns
  that end in that block;
* the words themselves are compared, hash by hash and then as bytes, before an occurrence
  counts.

The search jumps through many stretches of text at once (numpy arrays of positions), so it
looks at few words of clean text.  Word hashes are computed only where it looks.

The benchmark is cut into blocks of a bounded size by a hash of the item id; each block's
tables are a broadcast of bounded size, and documents pass once per block without a shuffle.

Nulls and empty texts have no words: no window, no hit.  A null item id counts as the empty
string.  Repeated items count once by id; repeated documents are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Scratch, free_name, named, others, table
from tessera.llm.tokens import ALNUM_WORD, BYTE_BASE, FOLDED, Rolling, Words, find_words, mix, slices

WINDOW = 13
BLOCK_BYTES = 8 << 20           # benchmark text in one broadcast block of patterns
LANE = 1024                     # words that one search position passes over
U64 = np.uint64


def _blocks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * U64(0x9E3779B97F4A7C15) + second)


class Searcher:
    """Wu-Manber tables for distinct patterns of one length (in words)."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]], hashes: dict[bytes, int]):
        self.words = list(patterns)
        self.items = [patterns[p] for p in self.words]
        self.m = len(self.words[0])
        self.block = min(2, self.m)
        h = np.array([[hashes[w] for w in p] for p in self.words], np.uint64)
        ends = h if self.block == 1 else _blocks(h[:, :-1], h[:, 1:])       # block ending at word j + block - 1
        self.bits = max(12, int(ends.size * 16 - 1).bit_length())
        self.shift = np.full(1 << self.bits, self.m - self.block + 1, np.int32)
        distance = np.broadcast_to(np.arange(ends.shape[1])[::-1], ends.shape)
        np.minimum.at(self.shift, self._slot(ends).ravel(), distance.ravel().astype(np.int32))
        order = np.argsort(ends[:, -1], kind="stable")
        self.words = [self.words[i] for i in order]
        self.items = [self.items[i] for i in order]
        self.hashes, self.suffix = h[order], ends[order, -1]

    def _slot(self, block: np.ndarray) -> np.ndarray:
        return (block >> U64(64 - self.bits)).astype(np.int64)

    def search(self, words: Words, roll: Rolling) -> tuple[np.ndarray, np.ndarray]:
        """(end word, pattern) of every occurrence."""
        m, n = self.m, words.counts
        first = words.first[:-1]
        lanes = -(-np.maximum(n - m + 1, 0) // LANE)                        # of each text, over its possible ends
        text = np.repeat(np.arange(len(n)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        pos = first[text] + m - 1 + nth * LANE
        limit = np.minimum(pos + LANE, first[text] + n[text])
        at, block_at = [], []
        while len(pos):
            block = self._ending_at(words, roll, pos)
            jump = self.shift[self._slot(block)]
            stop = jump == 0
            at.append(pos[stop])
            block_at.append(block[stop])
            pos = pos + np.maximum(jump, 1)
            on = pos < limit
            pos, limit = pos[on], limit[on]
        at, block = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((at, np.int64), (block_at, np.uint64)))
        return self._confirm(words, roll, at, block)

    def _ending_at(self, words: Words, roll: Rolling, pos: np.ndarray) -> np.ndarray:
        last = roll.of(words.start[pos], words.end[pos])
        return last if self.block == 1 else _blocks(roll.of(words.start[pos - 1], words.end[pos - 1]), last)

    def _confirm(self, words: Words, roll: Rolling, at: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.searchsorted(self.suffix, block), np.searchsorted(self.suffix, block, "right")
        n = hi - lo
        pattern = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        end = np.repeat(at, n)
        for j in range(self.m):                                             # prefix first: most candidates fail there
            w = end - (self.m - 1) + j
            same = roll.of(words.start[w], words.end[w]) == self.hashes[pattern, j]
            end, pattern = end[same], pattern[same]
        same = np.fromiter((self._equal(words, e, p) for e, p in zip(end.tolist(), pattern.tolist())), bool, len(end))
        return end[same], pattern[same]

    def _equal(self, words: Words, end: int, pattern: int) -> bool:
        expected = self.words[pattern]
        return all(words.data[words.start[w]:words.end[w]].tobytes().lower() == expected[j]
                   for j, w in enumerate(range(end - self.m + 1, end + 1)))


class Patterns:
    """Searchers for every pattern length of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, str | None]], size: int = WINDOW):
        self.by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
        for item, text in items:
            found = find_words(pa.array([text], pa.string()), ALNUM_WORD)
            w = [found.data[a:b].tobytes().lower() for a, b in zip(found.start, found.end)]
            k = min(size, len(w))
            for i in range(len(w) - k + 1 if k else 0):
                self.by_length.setdefault(k, {}).setdefault(tuple(w[i:i + k]), set()).add(item)
        self._searchers: list[Searcher] | None = None

    def searchers(self) -> list[Searcher]:
        if self._searchers is None:
            self._searchers = []
            for patterns in self.by_length.values():
                vocabulary = sorted({w for p in patterns for w in p})
                found = find_words(pa.array([b" ".join(vocabulary).decode()], pa.string()), ALNUM_WORD)
                hashes = dict(zip(vocabulary, found.hashes(FOLDED).tolist()))
                self._searchers.append(Searcher(patterns, hashes))
        return self._searchers


def _scan(rows: pa.RecordBatch, text: str, patterns: Patterns) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
    """Word counts, hit word ranges [start, end) and found items of each row."""
    words = find_words(rows.column(rows.schema.get_field_index(text)), ALNUM_WORD)
    roll = Rolling(FOLDED[words.data], BYTE_BASE)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(rows.num_rows)]
    items: list[set[str]] = [set() for _ in range(rows.num_rows)]
    for s in patterns.searchers():
        ends, found = s.search(words, roll)
        doc = np.searchsorted(words.first, ends, "right") - 1
        for d, e, p in zip(doc.tolist(), (ends - words.first[doc] + 1).tolist(), found.tolist()):
            spans[d].append((e - s.m, e))
            items[d] |= s.items[p]
    return words.counts, spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint ranges that cover the same words."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find_benchmark(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", size: int = WINDOW, prefix: str = "bench_",
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with three more columns: ``{prefix}words`` (words of the text), ``{prefix}spans``
    (disjoint word ranges that occur in the benchmark) and ``{prefix}items`` (ids of the items found);
    old columns of these names go."""
    names = [f"{prefix}{c}" for c in ("words", "spans", "items")]
    docs = docs.select(*(named(c) for c in others(docs, names)))
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-int(total) // block_bytes))
    out = docs.withColumns({names[0]: F.lit(0).cast("long"), names[1]: F.lit(None).cast(SPANS),
                            names[2]: F.lit(None).cast("array<string>")})
    schema = out.schema
    scratch = Scratch(spark, "decontaminate")
    for k in range(n_blocks):
        block = items.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == k)
        shared = spark.sparkContext.broadcast(Patterns([(r["id"], r["t"]) for r in block.toLocalIterator()], size))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            patterns = shared.value
            for rows in slices(batches, text):
                counts, spans, found = _scan(rows, text, patterns)
                before = [rows.column(rows.schema.get_field_index(c)).to_pylist() for c in names[1:]]
                spans = [merged(s + [(x["start"], x["end"]) for x in b or ()]) for s, b in zip(spans, before[0])]
                found = [sorted(f.union(b or ())) for f, b in zip(found, before[1])]
                keep = [rows.column(i) for i, c in enumerate(rows.schema.names) if c not in names]
                yield pa.RecordBatch.from_arrays(
                    [*keep, pa.array(counts, pa.int64()),
                     pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _ARROW_SPANS),
                     pa.array(found, pa.list_(pa.string()))], names=rows.schema.names)

        out = out.mapInArrow(search, schema)
        if k < n_blocks - 1:                # one block's tables in memory at a time
            out = scratch.write(out, f"block{k}")
    return out


def hit_words(spans) -> F.Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def is_contaminated(words, spans) -> F.Column:
    """At least one hit word, and at least a twentieth of all words hit."""
    return (hit_words(spans) > 0) & (hit_words(spans) * 20 >= words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    prefix = free_name([c[:len(c) - len(s)] for c in docs.columns for s in ("words", "spans", "items")], "bench_")
    found = find_benchmark(docs, benchmark, prefix=prefix, **options)
    return found.where(~is_contaminated(F.col(f"{prefix}words"), F.col(f"{prefix}spans"))).select(*(named(c) for c in docs.columns))


def op2_wu_manber(spark, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("bench_words").alias("n_words"), hit_words(F.col("bench_spans")).alias("n_hit"),
        F.size("bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("bench_items"), ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("bench_words"), F.col("bench_spans")).alias("contaminated"))
