"""MinHash near-dedup with odd sketches.

1. One pass computes each document's shingle set (five words), its digest, ``BANDS x ROWS``
   MinHash samples folded into band keys, and an odd sketch: a parity bitmap in which every
   sample flips one bit.
2. Documents with equal sets collapse into one node, so groups of copies cost one row.
3. Nodes meet in band buckets. A bucket is never paired out: each member is paired with its
   bucket's hub, the member that meets most others. The XOR of two odd sketches has a
   population count from which the similarity is estimated; clearly lower pairs end here.
   Nodes that share buckets also get a second odd sketch, of their whole set: its XOR never
   has more bits than the sets differ in, so too many bits prove that a pair is below the limit.
4. The other pairs are confirmed on their full shingle sets. Links become components. While
   that links many, buckets whose members are still in several components get another
   hub; at last come all pairs *between* components that pass both sketches. Pairs inside a
   component need no check: they can't change it. So each pair of different texts that shares
   a bucket is confirmed, rejected by its full sets or sketches, or already in one component.

Two sets at the limit of 0.75 miss all 32 buckets of four samples with probability 5e-6, and
their sketch estimate is below the cut-off (5 standard deviations) about as rarely.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z is lower-cased.  A text of one to four words has its
whole sequence as one shingle; a null or empty one has none, and links with nothing.  Rows
with equal sets belong together whatever their id; a null id has no component and is kept, but
its text links its neighbours like any other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, bitmap, in_bitmap, named, packed, table
from tessera.llm.tokens import FOLDED, SPACE_WORD, WORD_BASE, Rolling, find_words, mix, slices

SHINGLE = 5
SIMILARITY = 75                     # per cent
BANDS, ROWS = 32, 4
SKETCH_BITS = 512
MARGIN = 5.0                        # standard deviations of the estimate below the limit
HUB_ROUNDS = 3
LEAST_GAIN = 0.05                    # of the first round's links, for another hub round
SET_BITS = 4                         # bits of a whole set's sketch for each shingle, at least
U32, U64 = np.uint32, np.uint64

_RNG = np.random.default_rng(75)
MULTIPLY = _RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.int64).astype(U32) * U32(2) + U32(1)
FLIP = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.int64).astype(U32)


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit shingle hashes of each text, in order, and the first of each text (one more at the end)."""
    words = find_words(column, SPACE_WORD)
    counts = words.counts
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(n)))
    start = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], n)
    length = np.repeat(np.minimum(counts, size), n)
    h = Rolling(words.hashes(FOLDED), WORD_BASE).of(start, start + length)
    return mix(h ^ length.astype(U64)), first


def _sets(column: pa.Array) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    h, first = shingles(column)
    return [np.unique(h[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BANDS * ROWS samples for each non-empty set."""
    x = (np.concatenate(sets) >> U64(32)).astype(U32)
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), BANDS * ROWS), U32)
    work = np.empty_like(x)
    for i, (a, c) in enumerate(zip(MULTIPLY, FLIP)):
        np.bitwise_xor(x, c, out=work)
        np.multiply(work, a, out=work)
        out[:, i] = np.minimum.reduceat(work, at)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band; keys of different bands differ."""
    s = samples.reshape(len(samples), BANDS, ROWS).astype(U64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), s.shape[:2])
    for r in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + s[:, :, r])
    return key


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps, as eight 64-bit words a row: sample i flips the bit at hash(i, value)."""
    place = (mix(samples.astype(U64) + (np.arange(samples.shape[1], dtype=U64) << U64(32))) % U64(SKETCH_BITS)).astype(np.int64)
    bits = np.zeros((len(samples), SKETCH_BITS), np.uint8)
    np.add.at(bits, (np.arange(len(samples))[:, None], place), 1)
    return np.packbits(bits & 1, axis=1, bitorder="little").view(np.uint64)


def sketch_limit(similarity: int = SIMILARITY, margin: float = MARGIN) -> int:
    """Most differing bits of two sketches whose similarity may reach the limit.

    Samples that differ number k(1 - J) and leave two bits to flip each; a bitmap of n bits
    flipped m times has n/2 (1 - (1 - 2/n)^m) odd bits."""
    k, n, j = BANDS * ROWS, SKETCH_BITS, similarity / 100
    least = max(0.0, j - margin * math.sqrt(j * (1 - j) / k))
    return math.ceil(n / 2 * (1 - (1 - 2 / n) ** (2 * k * (1 - least))))


def estimate(differing: int) -> float:
    """Similarity estimated from the number of differing bits."""
    k, n = BANDS * ROWS, SKETCH_BITS
    return 1 + n / (4 * k) * math.log(max(1 - 2 * differing / n, 1e-9))


def set_sketch(s: np.ndarray) -> np.ndarray:
    """Odd sketch of a whole set, in a power of two of bits: every shingle flips one."""
    words = max(8, 1 << max(0, (len(s) * SET_BITS - 1).bit_length() - 6))
    place = (mix(s + U64(0x9E3779B97F4A7C15)) & U64(words * 64 - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=words * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


SIGNATURE = "text_hash long, shingles long, digest binary, bands array<long>, sketch array<long>"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, "text"):
        sets = _sets(rows.column(2))
        n = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(n)
        bands, sketch = [None] * len(sets), [None] * len(sets)
        if len(full):
            samples = minhash([sets[i] for i in full])
            for i, b, s in zip(full.tolist(), band_keys(samples).view(np.int64), odd_sketch(samples).view(np.int64)):
                bands[i], sketch[i] = b, s
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(n), pa.array([_digest(s) for s in sets], pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))],
            names=["id", "text_hash", "shingles", "digest", "bands", "sketch"])


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def differing_bits(a: Column, b: Column) -> Column:
    """Population count of the XOR of two sketches."""
    total = F.lit(0)
    for i in range(SKETCH_BITS // 64):
        total = total + F.bit_count(a[i].bitwiseXOR(b[i]))
    return total


def least_difference(a: Column, b: Column) -> Column:
    """A lower bound of the sets' symmetric difference: odd bits of the XOR of two whole-set sketches.

    Set sizes within the limit have sketches of equal length or of twice the length; the longer
    one is folded, as if it had been made with half the bits."""
    def folded(x: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))

    def bits(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, c: n + c)

    return F.when(F.size(a) == F.size(b), bits(a, b)).when(F.size(a) > F.size(b), bits(folded(a), b)) \
        .otherwise(bits(a, folded(b)))


class _Links:
    """Confirmed links between nodes, and the components they make."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, scratch: Scratch, similarity: int):
        self.nodes, self.sets, self.scratch, self.similarity = nodes, sets, scratch, similarity
        self.round, self.links, self.tried, self.component = 0, None, None, None

    def confirm(self, pairs: DataFrame) -> int:
        """Checks distinct pairs (a < b) on their full sets; the number of links among them.

        Pairs checked before aren't repeated."""
        self.round += 1
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        a, b = (self.sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
        both = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - both
        checked = pairs.join(a, "a").join(b, "b").select("a", "b", both.alias("both"), union.alias("union")) \
            .select("a", "b", (F.col("both").cast("long") * 100 >= F.col("union").cast("long") * self.similarity).alias("linked"))
        checked = self.scratch.write(checked, f"checked{self.round}")
        new = checked.where("linked").select("a", "b")
        self.tried = checked.select("a", "b") if self.tried is None else self.tried.union(checked.select("a", "b"))
        self.links = new if self.links is None else self.links.union(new)
        self.component = components(self.links, self.scratch, f"round{self.round}")
        return new.count()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every linked node: the smallest node reachable.

    Each round takes the smallest label among a node and its neighbours, then the label of
    that label, so paths shorten by more than half; it ends when no label changes."""
    both = scratch.write(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-links")
    labels = scratch.write(both.groupBy(F.col("a").alias("node"))
                           .agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("component")), f"{name}-0")
    k = 0
    while True:
        k += 1
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        next_ = labels.join(near, "node").select("node", F.col("component").alias("was"),
                                                 F.least("component", "near").alias("component"))
        up = next_.select(F.col("node").alias("component"), F.col("component").alias("up"))
        jumped = next_.join(up, "component", "left") \
            .select("node", "was", F.least("component", F.coalesce("up", "component")).alias("component"))
        written = scratch.write(jumped, f"{name}-{k}")
        changed = written.where("was != component").limit(1).count()
        scratch.drop(f"{name}-{k - 1}")
        labels = written.select("node", "component")
        if not changed:
            scratch.drop(f"{name}-links")
            return labels


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                    similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest id of the group) and ``kept`` of every row."""
    return _groups(docs, doc_id, text, similarity).select(
        F.col("id").alias(doc_id), F.col("shingles").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _groups(docs: DataFrame, doc_id: str, text: str, similarity: int) -> DataFrame:
    """id, text_hash, shingles and component_id of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "oddsketch")
    source = docs.select(named(doc_id).alias("id"), F.xxhash64(named(text)).alias("text_hash"), named(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    signed = scratch.write(source.mapInArrow(_signatures, f"id {kind}, {SIGNATURE}"), "signed")
    alike = signed.where("digest is not null").groupBy("digest").agg(
        F.min("id").alias("id"), F.min("text_hash").alias("text_hash"),
        F.first(F.struct("shingles", "bands", "sketch")).alias("s"))
    nodes = scratch.write(alike.select(F.monotonically_increasing_id().alias("node"), "digest", "id", "text_hash", "s.*"), "nodes")

    member = nodes.select("node", F.explode("bands").alias("band"))
    shared = member.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    buckets = scratch.write(member.join(shared, "band"), "buckets")
    candidates = scratch.write(buckets.select("node").distinct()
                               .join(nodes.select("node", "digest", "id", "text_hash", "shingles", "sketch"), "node"), "candidates")

    key = F.when(F.col("id").isNotNull(), F.xxhash64("id")).otherwise(F.col("text_hash"))
    wanted = spark.sparkContext.broadcast(bitmap(candidates.select(key.alias("key")), "key"))

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            at = np.flatnonzero(in_bitmap(bits, batch.column(1).to_numpy()))
            for rows in slices(iter([batch.take(pa.array(at))]), "text"):
                sets = _sets(rows.column(2))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([_digest(s) for s in sets], pa.binary()),
                     pa.array([set_sketch(s).view(np.int64) for s in sets], pa.list_(pa.int64())),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "digest", "parity", "set"])

    full = f"id {kind}, digest binary, parity array<long>, set array<long>"
    columns = ["node", "shingles", "sketch", "parity", "set"]
    found = source.where("id is not null").select("id", F.xxhash64("id").alias("key"), "text").mapInArrow(full_sets, full)
    # a node whose rows all have a null id is found by its text; each such text is looked at once
    unnamed = source.where("id is null").dropDuplicates(["text_hash"]) \
        .select("id", F.col("text_hash").alias("key"), "text").mapInArrow(full_sets, full).dropDuplicates(["digest"])
    sets = scratch.write(
        candidates.join(found, ["id", "digest"]).select(*columns)
        .union(candidates.where("id is null").join(unnamed.drop("id"), "digest").select(*columns)), "sets")

    links = _Links(nodes, sets, scratch, similarity)
    sketches = sets.drop("set")
    hubs, first = None, 0
    for _ in range(HUB_ROUNDS):
        hubs, pairs = _hub_pairs(_open_buckets(buckets, links.component), hubs, links)
        linked = links.confirm(_plausible(pairs, sketches, similarity))
        first = first or linked
        if linked <= first * LEAST_GAIN or not linked:      # what is left is for the pairs between components
            break
    links.confirm(_between(_open_buckets(buckets, links.component), sketches, similarity))

    group = nodes.join(links.component, "node", "left").select(
        "digest", "id", F.coalesce("component", "node").alias("component"))
    least = group.groupBy("component").agg(F.min("id").alias("component_id"))
    group = scratch.write(group.join(least, "component").select("digest", "component_id"), "groups")
    scratch.drop("sets", "buckets", *(f"hubs{k}" for k in range(links.round)), "candidates", "nodes", *(f"checked{k + 1}" for k in range(links.round)))
    out = signed.select("id", "text_hash", "shingles", "digest").join(group, "digest", "left")
    return out.select("id", "text_hash", "shingles",
                      F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def _open_buckets(buckets: DataFrame, component: DataFrame | None) -> DataFrame:
    """Members (with their component) of the buckets that hold more than one component."""
    if component is None:
        return buckets.select("band", "node", F.col("node").alias("component"))
    known = buckets.join(component, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    mixed = known.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .where("lo < hi").select("band")
    return known.join(mixed, "band")


def _hub_pairs(members: DataFrame, before: DataFrame | None, links: _Links) -> tuple[DataFrame, DataFrame]:
    """(band, node) of all hubs so far, and pairs of a new hub with its bucket's members of other components.

    The hub is the member that meets most others over all its buckets: in a group of edited
    copies that is the original, which is nearer to each copy than the copies to each other.
    Components of a bucket's earlier hubs give no hub again."""
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    met = members.join(sizes, "band").groupBy("node").agg(F.sum("n").alias("met"))
    eligible = members.join(met, "node")
    if before is not None:
        seen = before.join(links.component, "node", "left").select("band", F.coalesce("component", "node").alias("component"))
        eligible = eligible.join(seen.distinct(), ["band", "component"], "left_anti")
    hubs = eligible.groupBy("band").agg(F.max(F.struct("met", "node", "component")).alias("hub")) \
        .select("band", F.col("hub.node").alias("hub"), F.col("hub.component").alias("hub_component"))
    hubs = links.scratch.write(hubs, f"hubs{links.round}")
    pairs = members.join(hubs, "band").where("component != hub_component") \
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    new = hubs.select("band", F.col("hub").alias("node"))
    return (new if before is None else before.union(new)), pairs


def _side(c: str) -> list[Column]:
    return [F.col("node").alias(c), F.col("shingles").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"), F.col("parity").alias(f"p{c}")]


def _plausible(pairs: DataFrame, sketches: DataFrame, similarity: int) -> DataFrame:
    """Pairs whose set sizes and sketches allow the limit."""
    a, b = (sketches.select(*_side(c)) for c in "ab")
    return pairs.join(a, "a").join(b, "b").where(_allowed(similarity)).select("a", "b")


def _allowed(similarity: int) -> Column:
    """By set sizes, by the sketches of samples, and by the sketches of the whole sets: sets of sizes
    p and q with a similarity of s differ in (p + q)(1 - s) / (1 + s) shingles at most."""
    c = F.col
    near = differing_bits(c("sa"), c("sb")) <= sketch_limit(similarity)
    possible = least_difference(c("pa"), c("pb")) * (100 + similarity) <= (c("na") + c("nb")) * (100 - similarity)
    return (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * similarity) & near & possible


def _between(members: DataFrame, sketches: DataFrame, similarity: int) -> DataFrame:
    """All pairs of different components in a bucket that the sketches allow."""
    rows = members.join(sketches, "node")
    a, b = (rows.select("band", F.col("component").alias(f"c{c}"), *_side(c)).alias(side) for c, side in (("a", "l"), ("b", "r")))
    on = (F.col("l.band") == F.col("r.band")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _allowed(similarity)
    return a.join(b, on).select("a", "b").distinct()


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """One document of each near-duplicate group, columns unchanged: the one with the smallest id.

    Rows that repeat that id within the group are reduced to one; rows with a null id all stay."""
    first = Window.partitionBy("id").orderBy("text_hash")
    keep = _groups(docs, doc_id, text, similarity).where("id = component_id") \
        .groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("place", F.row_number().over(first)).where("place = 1").select("id", "text_hash")
    rows = packed(docs, id=doc_id, text=text).select("row", "id", F.xxhash64("text").alias("text_hash"))
    one = rows.where("id is not null").join(keep, ["id", "text_hash"], "left_semi").dropDuplicates(["id", "text_hash"])
    return one.select("row.*").union(rows.where("id is null").select("row.*"))


def op5_odd_sketch(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
