"""Exact centroid clustering with heap-ordered bounds.

Every vector carries one number, the gap between a lower bound of the distance to its
second-nearest centroid and an upper bound of the distance to its own.  When centroids move,
the gap of a vector of cluster c shrinks by at most ``drift(c) + max drift(others)``.  Instead
of lowering all gaps, each cluster accumulates that amount in ``spent[c]``, and a vector is
stored under the key ``gap + spent[c]`` of the time of its last exact scan: it must be looked
at again only when ``spent[c]`` has reached its key.

Each cluster's heap is kept on storage, as runs in key order: every round writes the vectors
that it scanned as one run, sorted by (cluster, key) within each file.  Popping is a range of keys
per cluster, ``spent before < key <= spent now``, pushed to the Parquet scan, so that row groups whose
vectors stay safe are not read; an entry popped once lies below every later range and needs no
deletion.  Popped vectors are compared with all centroids (integers, exact) and go into the next run;
their centroids' sums change by the vectors that moved.  Vectors are never shuffled: a round moves
one vector of sums per task and cluster, and the driver holds the centroids only, so a cluster of
any share of the rows needs no splitting.

Ties go to the smaller centroid number.  Keys are floats and lowered by ``SAFETY`` of the distances,
which only causes scans that were not needed.

Kept are vectors with exactly ``dims`` components, none null, NaN, infinite or beyond ``LIMIT`` after
scaling (beyond it squared distances would not fit a long); all others are left out, null vectors
included.  Rows are vectors, so repeated ids and repeated rows count each; a null id is hashed as an
empty one.  Fewer kept vectors than centroids asked for: every vector starts a centroid.  No kept
vectors: an empty result.  Columns other than id and vector play no part, whatever their names.  A sum of
distances that doesn't fit a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, named, sha, table

CLUSTERS, ROUNDS, SEED, DIMS, SCALE = 8, 10, 3, 64, 1024
LIMIT = 1 << 27                     # of a scaled component: 64 squared differences then fit a long
SAFETY = 1e-9
BATCH = 1 << 14                     # vectors compared at once in a task


@dataclass
class Clustering:
    """``rows``: vec_id, cluster, distance (squared) of each kept vector; ``scanned``: vectors compared
    with all centroids in each assignment."""
    rows: DataFrame
    centroids: np.ndarray
    scanned: list[int] = field(default_factory=list)


def kept_vectors(df: DataFrame, vec_id: str, vector: str, dims: int, scale: float) -> DataFrame:
    """vec_id and x, the scaled components rounded down, of the vectors that can be clustered."""
    scaled = F.transform(named(vector), lambda v: v.cast("double") * float(scale))
    odd = F.exists("v", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > float(LIMIT)))
    return df.select(named(vec_id).alias("vec_id"), scaled.alias("v")) \
        .where((F.size("v") == dims) & ~odd) \
        .select("vec_id", F.transform("v", lambda v: F.floor(v).cast("int")).alias("x"))


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of their id; equal ids by their components."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.select(sha(text).alias("h"), "x").orderBy("h", "x").limit(clusters).collect()
    return np.array([r["x"] for r in first], np.int64)


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    x = batch.column(batch.schema.get_field_index("x"))
    return x.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, gap to the second), by exact squared distances."""
    n = len(x)
    best, best_d = np.zeros(n, np.int32), np.full(n, np.iinfo(np.int64).max)
    second = best_d.copy()
    for c, centre in enumerate(centroids):
        d = ((x - centre) ** 2).sum(1)
        closer = d < best_d
        second = np.where(closer, best_d, np.minimum(second, d))
        best[closer] = c
        best_d = np.where(closer, d, best_d)
    own, other = np.sqrt(best_d.astype(float)), np.sqrt(second.astype(float))
    gap = other - own - SAFETY * (other + own)
    if len(centroids) == 1:
        gap[:] = np.inf
    return best, gap


def _scanner(centroids: np.ndarray, spent: np.ndarray):
    dims = centroids.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                best, gap = nearest(_matrix(b, dims), centroids)
                offset = spent[best]
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index("vec_id")), b.column(b.schema.get_field_index("x")),
                     b.column(b.schema.get_field_index("cluster")), pa.array(best), pa.array(gap + offset - SAFETY * offset)],
                    names=["vec_id", "x", "before", "cluster", "key"])
    return scan


def _summed(clusters: int, dims: int):
    """One row per task and cluster: vectors scanned, and the change of the cluster's count and sums."""
    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((clusters, dims + 2), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                x = np.column_stack((np.ones(b.num_rows, np.int64), _matrix(b, dims)))
                old, new = (b.column(b.schema.get_field_index(k)).to_numpy() for k in ("before", "cluster"))
                sums[:, 0] += np.bincount(new, minlength=clusters)
                moved = np.flatnonzero(old != new)
                np.add.at(sums[:, 1:], new[moved], x[moved])
                left = moved[old[moved] >= 0]
                np.subtract.at(sums[:, 1:], old[left], x[left])
        some = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(list(sums[some]), pa.list_(pa.int64()))],
                                         names=["cluster", "change"])
    return change


def _changes(run: DataFrame, clusters: int, dims: int) -> np.ndarray:
    """The run's changes per cluster as exact Python integers: scanned, count, sums (clusters x dims + 2 numbers)."""
    tasks = run.select("x", "before", "cluster").mapInArrow(_summed(clusters, dims), "cluster int, change array<long>")
    total = tasks.select("cluster", F.posexplode("change").alias("i", "n")).groupBy("cluster", "i") \
        .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    out = np.zeros((clusters, dims + 2), object)
    for r in total.collect():
        out[r["cluster"], r["i"]] = int(r["n"])
    return out


def _popped(before: np.ndarray | None, now: np.ndarray) -> Column:
    """Entries whose key the accumulated drift has passed; ``before`` None: of the newest run, where all are alive."""
    def of(c: int) -> Column:
        key = F.col("key")
        reached = key <= float(now[c])
        return (F.col("cluster") == c) & (reached if before is None else reached & (key > float(before[c])))

    changed = [of(c) for c in range(len(now)) if before is None or now[c] > before[c]]
    return reduce(lambda a, b: a | b, changed, F.lit(False))


def _to_own(centroids: np.ndarray):
    dims = centroids.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                own = b.column(b.schema.get_field_index("cluster"))
                d = ((_matrix(b, dims) - centroids[own.to_numpy()]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("vec_id")), own, pa.array(d)],
                                                 names=["vec_id", "cluster", "distance"])
    return measure


def cluster_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: float = SCALE) -> Clustering:
    """``rounds`` times assign and move the centroids, then assign once more; equal to scanning every
    vector every time."""
    scratch = Scratch(df.sparkSession, "heapmeans")
    vectors = kept_vectors(df, vec_id, vector, dims, scale)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    entry = f"vec_id {id_type}, x array<int>, before int, cluster int, key double"
    centroids = first_centroids(vectors, clusters, seed)
    k = len(centroids)
    if not k:
        none = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clustering(none, np.zeros((0, dims), np.int64))
    spent, totals, scanned, runs = np.zeros(k), np.zeros((k, dims + 1), object), [], []

    def read(names: list[str]) -> list[DataFrame]:
        """One scan over runs."""
        return [df.sparkSession.read.schema(newest.schema).parquet(*(f"{scratch.base}/{n}" for n in names))] if names else []

    todo = vectors.withColumn("cluster", F.lit(-1))
    while True:
        fresh = todo.select("vec_id", "x", "cluster").mapInArrow(_scanner(centroids, spent), entry)
        runs.append(f"run{len(runs)}")
        newest = scratch.write(fresh.sortWithinPartitions("cluster", "key"), runs[-1])
        change = _changes(newest, k, dims)
        scanned.append(int(change[:, 0].sum()))
        totals += change[:, 1:]
        if len(runs) > rounds:
            break
        moved = np.array([[s // n for s in row] if n else old.tolist()
                          for (n, *row), old in zip(totals.tolist(), centroids)], np.int64)
        drift = np.sqrt(((moved - centroids).astype(float) ** 2).sum(1)) * (1 + SAFETY)
        centroids = moved
        if not drift.any():                         # nothing moves any more: later rounds change nothing
            break
        most = np.sort(drift)[::-1]
        others = np.where(drift == most[0], most[1] if k > 1 and (drift == most[0]).sum() == 1 else most[0], most[0])
        before, spent = spent, spent + (drift + others) * (1 + SAFETY)
        todo = reduce(DataFrame.unionAll, [newest.where(_popped(None, spent)), *(r.where(_popped(before, spent)) for r in read(runs[:-1]))])
    alive = reduce(lambda a, b: a | b, [(F.col("cluster") == c) & (F.col("key") > float(spent[c])) for c in range(k)])
    rows = reduce(DataFrame.unionAll, [newest, *(r.where(alive) for r in read(runs[:-1]))]).select("vec_id", "x", "cluster") \
        .mapInArrow(_to_own(centroids), f"vec_id {id_type}, cluster int, distance long")
    out = scratch.write(rows, "result")
    scratch.drop(*runs)
    return Clustering(out, centroids, scanned)


def with_inertia(found: Clustering) -> DataFrame:
    """The rows with their cluster's sum of distances, the sum over all and the final centroid's digest."""
    rows = found.rows
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.try_sum("distance").alias("s")).collect()}
    whole = sum(sums.values()) if None not in sums.values() else None
    whole = whole if whole is not None and whole < 1 << 63 else None
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]

    def pick(values: list, kind: str) -> Column:
        listed = F.array(*(F.lit(v).cast(kind) for v in values)) if values else F.lit(None).cast(f"array<{kind}>")
        return F.get(listed, F.col("cluster"))

    return rows.select(
        "vec_id", "cluster", "distance",
        pick([sums.get(c) for c in range(len(names))], "long").alias("cluster_inertia"),
        F.lit(whole).cast("long").alias("inertia"), pick(names, "string").alias("centroid_sha256"))


def op11_heap_bounds(spark, sf_dir: str) -> DataFrame:
    """Eight clusters of all embeddings after ten rounds."""
    return with_inertia(cluster_vectors(table(spark, sf_dir, "embeddings")))


def oracle_sql() -> str:
    """The rounds one after another, every vector against every centroid."""
    steps = []
    for r in range(ROUNDS):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c FROM
  (SELECT v.r, m.c, list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) ** 2))::BIGINT AS d FROM v, m{r} m) GROUP BY r),
m{r + 1} AS MATERIALIZED (SELECT m.c, coalesce(n.x, m.x) AS x FROM m{r} m LEFT JOIN
  (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM
    (SELECT c, i, sum(e)::BIGINT AS s, count(*) AS n FROM
      (SELECT a.c, unnest(v.x) AS e, unnest(range({DIMS})) AS i FROM a{r} a JOIN v USING (r)) GROUP BY c, i) GROUP BY c) n USING (c))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(e::DOUBLE * {SCALE})::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM
  (SELECT sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT {CLUSTERS})),{','.join(steps)},
last AS (SELECT r, min(d) AS distance, arg_min(c, (d, c)) AS c FROM
  (SELECT v.r, m.c, list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) ** 2))::BIGINT AS d FROM v, m{ROUNDS} m) GROUP BY r)
SELECT vec_id, c::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM last JOIN v USING (r) JOIN m{ROUNDS} m USING (c)"""
