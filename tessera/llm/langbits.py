"""Language identification with language-bitmask n-gram filters.

1. Texts are read as letter runs, lower-cased, with one space for every run of other characters.  Their
   character n-grams of the lengths ``GRAMS`` (a space only at an end) are counted per language, once per
   training document.  A language keeps the ``PROFILE`` n-grams that are in the most of its documents, but none
   below the share ``LEAST_SHARE``.
2. The kept n-grams of each language fill a Bloom filter of ``BITS`` bits with ``HASHES`` places each, on
   Spark (``bitmap_construct_agg``, pieces of 4 KB).  The filters are then turned around into bit slices:
   row p holds one bit per language, so the AND of an n-gram's ``HASHES`` rows is the set of all languages
   whose filter has it.
3. A text's n-grams are looked up all at once; the popcount of each language's bit over them is its
   number of hits.  A filter whose bits are set with density f answers an unknown n-gram falsely with
   f ** ``HASHES``; that share is taken off: ``(hits - n * false) / (1 - false)``, at least 0.
4. The language with the largest corrected count wins; ties go to the language with more training
   documents, then to the smaller name.  The score is its part of the corrected counts of all languages;
   0 if no n-gram is known.

Training reads rows whose ``crc32(doc_id as text) mod 3`` is not 1 (a null id is hashed as empty), with a
language; per language about ``SAMPLE`` documents at most by a hash of id and text (the documented bound of
the fit; a language with fewer gives all).  Predictions use the whole text and nothing else; they don't
depend on other rows.  Null texts and texts without a letter (``\\p{L}``) are ``und`` with score 0, and so is every
text if there is nothing to learn from.  The slices take BITS / 8 bytes per language, 16 KB; more than
``MOST_LANGUAGES`` labels (64 MB) are an error, since these would be no languages.  Other columns pass through; old
columns of the result's names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, free_name, named, others, table
from tessera.llm.tokens import U64, mix, slices

GRAMS = (2, 3, 4)
PROFILE, LEAST_SHARE = 4096, 0.002
SAMPLE = 4000
BITS, HASHES = 1 << 17, 3
MOST_LANGUAGES = 4096
UNKNOWN = "und"
PIECE = 1 << 16                     # code points looked up at once, for up to 64 languages
TRAIN_BYTES = 4 << 20               # text counted together before its counts leave the task
_FACTORS = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5))


class Letters:
    """Code points of texts, lower-cased, with one space around and between the runs of letters."""

    def __init__(self):
        self.kind = np.zeros(0x110000, np.int8)             # 0 not seen yet, 1 letter, 2 other
        self.letter = regex.compile(r"\p{L}")

    def of(self, text: str) -> np.ndarray:
        """Empty if there is no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        for p in np.unique(points[self.kind[points] == 0]).tolist():
            self.kind[p] = 1 if self.letter.match(chr(p)) else 2
        inside = self.kind[points] == 1
        if not inside.any():
            return points[:0]
        keep = inside.copy()
        keep[1:] |= inside[:-1]                             # and the first other character after a run
        out = np.where(inside, points, 32)[keep]
        return np.concatenate(([32], out, [32] * int(out[-1] != 32))).astype(np.uint64)


def gram_pieces(points: np.ndarray, step: int = PIECE) -> Iterator[np.ndarray]:
    """64-bit hashes of all n-grams, those that start in the same ``step`` code points together."""
    for at in range(0, len(points), step):
        p = points[at:at + step + max(GRAMS) - 1]
        space, out = p == 32, []
        for n in GRAMS:
            m = min(step, len(p) - n + 1)
            if m <= 0:
                continue
            h, ok = np.full(m, U64(n)), np.ones(m, bool)
            for j in range(n):
                h = (h ^ p[j:j + m]) * _FACTORS[0]
                h ^= h >> U64(29)
                if 0 < j < n - 1:
                    ok &= ~space[j:j + m]
            out.append(mix(h[ok]))
        if out:
            yield np.concatenate(out)


def places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """The places of hashes in a filter of ``bits`` (a power of two) bits."""
    shift = U64(64 - (bits.bit_length() - 1))
    return [((h * factor) >> shift).astype(np.int64) for factor in _FACTORS[1:HASHES + 1]]


@dataclass
class Filters:
    """Bit slices: ``rows[place]`` has the bit of each language; ``false``: a language's rate of false hits.
    Languages go from the one with most training documents to the one with fewest."""
    languages: list[str]
    rows: np.ndarray
    false: np.ndarray

    @classmethod
    def of(cls, languages: list[str], blooms: np.ndarray) -> Filters:
        """From one bitmap (bytes, lowest bit first) per language."""
        bits = blooms.shape[1] * 8
        rows = np.zeros((bits, -(-len(languages) // 64)), np.uint64)
        density = np.zeros(len(languages))
        for i, bloom in enumerate(blooms):
            own = np.unpackbits(bloom, bitorder="little")
            density[i] = own.mean()
            rows[:, i // 64] |= own.astype(np.uint64) << U64(i % 64)
        return cls(languages, rows, density ** HASHES)

    def masks(self, h: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that have it, as words of 64 bits."""
        first, *more = places(h, len(self.rows))
        out = self.rows[first]
        for p in more:
            out &= self.rows[p]
        return out

    def hits(self, points: np.ndarray) -> tuple[np.ndarray, int]:
        """Hits of each language among the n-grams, and the number of n-grams."""
        found, n = np.zeros(len(self.languages), np.int64), 0
        for h in gram_pieces(points, max(256, PIECE // self.rows.shape[1])):
            n += len(h)
            bytes_ = self.masks(h).view(np.uint8).reshape(len(h), -1)
            found += np.unpackbits(bytes_, axis=1, bitorder="little", count=len(found)).sum(0, dtype=np.int64)
        return found, n

    def judge(self, text: str | None, letters: Letters) -> tuple[str, float]:
        points = letters.of(text) if text else ()
        if not len(points) or not self.languages:
            return UNKNOWN, 0.0
        found, n = self.hits(points)
        true = np.maximum(found - n * self.false, 0) / np.maximum(1 - self.false, 1e-9)
        best = int(np.argmax(true))
        return self.languages[best], float(true[best] / true.sum()) if true[best] > 0 else 0.0


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per language and n-gram; a null n-gram counts the documents."""
    letters = Letters()
    for rows in slices(batches, "text", TRAIN_BYTES):
        by: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            own = [np.unique(h) for h in gram_pieces(letters.of(text))]
            by.setdefault(lang, []).append(np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64))
        for lang, found in by.items():
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(h) + 1)), pa.concat_arrays([pa.array([None], pa.int64()), pa.array(h.view(np.int64))]),
                 pa.array(np.concatenate(([len(found)], n)))], names=["lang", "h", "n"])


def _placed(bits: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(1).to_numpy().view(np.uint64)
            for p in places(h, bits):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["lang", "p"])
    return place


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", profile: int = PROFILE,
          sample: int = SAMPLE, bits: int = BITS) -> Filters:
    """Filters from the documents that are not held out."""
    scratch = Scratch(docs.sparkSession, "langbits")
    rows = docs.select(named(lang).cast("string").alias("lang"), named(text).alias("text"), named(doc_id).alias("id")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} language labels")
    if not sizes:
        return Filters([], np.zeros((bits, 0), np.uint64), np.zeros(0))
    large = {k: n for k, n in sizes.items() if n > sample}
    if large:
        share = F.create_map(*(F.lit(x) for k, n in large.items() for x in (k, sample / n)))
        part = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
        rows = rows.where(part < F.coalesce(F.try_element_at(share, F.col("lang")), F.lit(1.0)))
    counts = scratch.write(rows.select("lang", "text").mapInArrow(_count, "lang string, h long, n long")
                           .groupBy("lang", "h").agg(F.sum("n").alias("n")), "counts")
    read = {r["lang"]: r["n"] for r in counts.where("h is null").collect()}
    languages = sorted(sizes, key=lambda k: (-sizes[k], k))
    least = F.create_map(*(F.lit(x) for k in languages for x in (k, LEAST_SHARE * read.get(k, 0))))
    best = counts.where(F.col("h").isNotNull() & (F.col("n") >= F.element_at(least, F.col("lang")))) \
        .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "h"))).where(F.col("r") <= profile)
    pieces = best.select("lang", "h").mapInArrow(_placed(bits), "lang string, p long").withColumn("p", F.col("p") + 1) \
        .groupBy("lang", F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
    blooms = np.zeros((len(languages), max(bits // 8, 4096)), np.uint8)
    row_of = {k: i for i, k in enumerate(languages)}
    for r in pieces.toLocalIterator():
        at = (r["k"] - 1) * 4096
        blooms[row_of[r["lang"]], at:at + 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    scratch.drop()
    return Filters.of(languages, blooms[:, :bits // 8])


def identify(docs: DataFrame, filters: Filters, text: str = "text", prefix: str = "lang_") -> DataFrame:
    """The documents with ``pred`` and ``score`` (names with ``prefix``)."""
    names = [f"{prefix}pred", f"{prefix}score"]
    keep = others(docs, names)
    column = free_name(keep, "text_read")
    shared = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.rows, filters.false))
    whole = docs.select(*(named(c) for c in keep), named(text).alias(column))
    schema = whole.select(*(named(c) for c in keep), F.lit("").alias(names[0]), F.lit(0.0).alias(names[1])).schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, known = Letters(), Filters(*shared.value)
        for rows in slices(batches, column):
            texts = rows.column(rows.num_columns - 1).to_pylist()
            found = [known.judge(t, letters) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(i) for i in range(len(keep))), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=[*keep, *names])

    return whole.mapInArrow(judge, schema)


def op12_language_bits(spark, sf_dir: str) -> DataFrame:
    """The language of every whole document, learned from the two thirds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
