"""Keyed window operations that stay balanced when one key holds a large share of rows.

* :func:`range_lead` is ``lead(v) OVER (PARTITION BY key ORDER BY seq)`` over a
  range partitioning on (key, chunk).  Keys that a sample shows to be hot are
  split into ordered chunks, as many as their rows ask for (a run of one
  sequence value too), so no task receives a whole hot key; each chunk's last row takes the first value of the key's next chunk
  from a small broadcast table.  Chunking never changes the answer, only the
  balance, so an approximate hot-key list is safe.  The output stays range
  partitioned and sorted by (key, sequence), which :func:`number_in_place`
  turns into ``row_number() OVER (ORDER BY key, sequence)`` without another
  shuffle.
* :func:`latest_per_key` is ``row_number() = 1`` alone in its window, which Spark
  plans as a partial ``WindowGroupLimit`` before the shuffle (one row per key and
  map task crosses the network, whatever the skew).
* :func:`keyed_carry` is ``last(value, ignorenulls)`` carried forward per key
  (or ``lag`` when the frame ends one row back), hot keys split the same way.
* :func:`global_row_number` numbers any frame in a given order the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.narrow import exchanged
from tessera.session import cut_lineage, input_bytes, materialize_sized

HOT_KEY_ROWS = 2_000_000      # a key above this many rows is split
CHUNK_ROWS = 500_000          # target rows per chunk of a hot key
SAMPLE_FRACTION = 0.01        # share of rows sampled to find hot keys
GROUP_CUTS = 256              # cuts that a row of a hot key is compared with in one step
MAX_BROADCAST_ROWS = 2_000_000
PARTITION_BYTES = 8 << 20     # stored bytes of a sorted partition's input; its rows take about twenty times that in memory
MAX_BROADCAST_BYTES = 64 << 20    # compressed parquet on storage; in memory it is a few times larger


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def _partitions(df: DataFrame, partitions: int | None) -> int:
    """As asked, else the session's shuffle partitions, or more where these would be too large to sort in memory."""
    return partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // PARTITION_BYTES))


def _dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` hashed by the columns where the session's own partitions would be too large for a sort in memory, else
    as it is: the window's exchange then does the same."""
    n = _partitions(df, None)
    return df if n <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(n, *by)


def sized_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                    max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """Materialise a small derived table (rows counted on the write, bytes read
    from storage) and broadcast it only if both are within bounds; beyond
    either it is returned for a shuffled join."""
    small, n, size = materialize_sized(df, "small")
    return (F.broadcast(small) if n <= max_rows and size <= max_bytes else small), n


def is_broadcast(df: DataFrame) -> bool:
    """Whether :func:`sized_broadcast` (or the caller) marked the table to be broadcast."""
    return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()


def hot_keys(df: DataFrame, keys: Sequence[str], seq: str, hot_rows: int = HOT_KEY_ROWS,
             chunk_rows: int = CHUNK_ROWS, fraction: float = SAMPLE_FRACTION,
             partitions: int | None = None) -> DataFrame:
    """Keys whose sampled row count says they would overfill a shuffle partition, with a chunk count.

    A key is hot above ``max(hot_rows, rows per partition)`` and is cut into
    chunks of ``max(chunk_rows, rows per partition / 2)``, where rows per
    partition is the sampled total over ``spark.sql.shuffle.partitions`` (a
    scalar subquery over the same sample).  So at any scale only keys that
    really unbalance a partition are split, and the per-chunk tables stay
    small.  At most ``total / hot threshold`` keys qualify, which bounds the
    table.
    """
    grouped = (_sample(df, fraction).select(*keys).groupBy(*keys)
               .agg((F.count("*") / F.lit(fraction)).alias("_rows")))
    per_part = grouped.agg(F.sum("_rows")).scalar() / F.lit(_partitions(df, partitions))
    threshold = F.greatest(F.lit(float(hot_rows)), per_part)
    chunk = F.greatest(F.lit(float(chunk_rows)), per_part / 2)
    return (grouped.where(F.col("_rows") > threshold)
            .select(*keys, F.ceil(F.col("_rows") / chunk).cast("long").alias("_nchunks")))


def _sample(df: DataFrame, fraction: float) -> DataFrame:
    return df if fraction >= 1.0 else df.sample(fraction=fraction, seed=17)


def chunk_cuts(df: DataFrame, hot: DataFrame, keys: Sequence[str], order: Sequence[str],
               fraction: float = SAMPLE_FRACTION, partitions: int | None = None) -> DataFrame:
    """Where the chunks of each hot key begin: one row per cut with ``_at`` (a position: struct of the
    ``order`` columns), ``_pieces`` (chunks that start there), ``_first`` (number of the first of them) and
    ``_group`` (its cut group, ``GROUP_CUTS`` cuts each).

    The sample's positions are counted, range partitioned and summed along the key, so a key has as many
    cuts as its rows ask for and no task gets all of its sample.  A position that alone holds more rows than a
    chunk (a run of one value) starts several chunks, which share its rows by hash.
    """
    places = _sample(df, fraction).select(*keys, _position(order).alias("_at"))
    counted = _join_keys(places, hot, keys, "inner").groupBy(*keys, "_nchunks", "_at").agg(F.count("*").alias("_w"))
    ranged = counted.repartitionByRange(_partitions(df, partitions), *keys, "_at")
    stored = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id()), "positions")
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = stored.groupBy(*keys, "_pid").agg(F.sum("_w").alias("_w"))      # a row per key and partition
    offsets = slices.select(*keys, "_pid", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_off"),
                            F.sum("_w").over(Window.partitionBy(*keys)).alias("_all"))
    inside = Window.partitionBy(*keys, "_pid").orderBy("_at")
    summed = _join_keys(stored.withColumn("_upto", F.sum("_w").over(inside)), offsets, keys, "inner", extra=["_pid"])
    # of the key's sampled rows, those of this position are _start .. _end
    end = F.col("_off") + F.col("_upto")
    chunk_of = lambda i: F.floor(i * F.col("_nchunks") / F.col("_all"))
    start = end - F.col("_w")
    starts_chunk = (start == 0) | (chunk_of(end - 1) > chunk_of(start - 1))
    pieces = F.greatest(F.ceil(F.col("_w") * F.col("_nchunks") / F.col("_all")), F.lit(1)).cast("long")
    by_place = Window.partitionBy(*keys).orderBy("_at")                      # a row per chunk of the key
    return summed.where(starts_chunk).select(*keys, "_at", pieces.alias("_pieces")).select(
        *keys, "_at", "_pieces",
        (F.sum("_pieces").over(by_place) - F.col("_pieces")).alias("_first"),
        F.floor((F.row_number().over(by_place) - 1) / F.lit(GROUP_CUTS)).alias("_group"))


def _position(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t)
    return _has_map(t.elementType) if isinstance(t, T.ArrayType) else isinstance(t, (T.MapType, T.VariantType))


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row (of all columns that can be hashed): equal only for equal rows, but for chance."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not _has_map(f.dataType)])


def _join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
               extra: Sequence[str] = ()) -> DataFrame:
    """Null-safe join on keys (plus plain equality on ``extra``), keeping the left
    key columns only."""
    r = right.select(*[F.col(k).alias(f"_rk_{k}") for k in [*keys, *extra]],
                     *[c for c in right.columns if c not in keys and c not in extra])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_rk_{k}"])
        cond = c if cond is None else cond & c
    for k in extra:
        c = left[k] == r[f"_rk_{k}"]
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_rk_{k}" for k in [*keys, *extra]])


def chunk_hot_keys(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], hot_rows: int = HOT_KEY_ROWS,
                   chunk_rows: int = CHUNK_ROWS, fraction: float = SAMPLE_FRACTION
                   ) -> tuple[DataFrame, list[str], int]:
    """Add ``_chunk`` (ordered slices of a hot key's rows by ``order``), ``_hot`` and ``_tie``, which comes last in
    the order of a hot key's rows.

    Returns the frame, the partitioning columns (keys, plus ``_chunk`` when some
    key is hot) and the number of hot keys.  With no hot key no column is added:
    a constant chunk would be folded out of a window's partitioning, and a range
    layout on it would then no longer satisfy the window.

    A row finds its chunk in two steps: the key's cut groups, then the cuts of one group, so the arrays that it is
    compared with stay short for a key of many thousand chunks.  Rows of one position that share out its
    chunks do so by ``_tie``; rows that are equal in every column stay together.
    """
    order = [order] if isinstance(order, str) else list(order)
    hot, n_hot = sized_broadcast(hot_keys(df, keys, order[0], hot_rows, chunk_rows, fraction))
    if not n_hot:
        return df, list(keys), 0
    cuts = cut_lineage(chunk_cuts(df, hot, keys, order, fraction), "cuts")
    groups, _ = sized_broadcast(cuts.groupBy(*keys, "_group").agg(F.min("_at").alias("_at"))
                                .groupBy(*keys).agg(F.array_sort(F.collect_list("_at")).alias("_groups")))
    leaves, _ = sized_broadcast(cuts.groupBy(*keys, "_group").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_first", "_pieces"))).alias("_cuts")))
    here = _position(order)
    # rows before the first sampled position belong to the first chunk
    group = F.greatest(F.size(F.filter("_groups", lambda g: g <= here)) - 1, F.lit(0)).cast("long")
    grouped = _join_keys(df, groups, keys, "left") \
        .withColumn("_hot", F.col("_groups").isNotNull()) \
        .withColumn("_group", F.when(F.col("_hot"), group)).drop("_groups")
    placed = _join_keys(grouped, leaves, keys, "left", extra=["_group"]) \
        .withColumn("_tie", F.when(F.col("_hot"), _row_hash(df))) \
        .withColumn("_cut", F.element_at(F.filter("_cuts", lambda c: c["_at"] <= here), -1))
    share = F.shiftright(F.col("_tie"), 32) + F.lit(1 << 31)                 # 0 .. 2^32 - 1, ordered like _tie
    piece = F.when(F.col("_cut._at") < here, F.col("_cut._pieces") - 1) \
        .otherwise(F.floor(share * F.col("_cut._pieces") / F.lit(float(1 << 32))))
    chunk = F.coalesce(F.col("_cut._first") + piece, F.lit(0)).cast("long")
    return placed.withColumn("_chunk", chunk).drop("_cut", "_cuts", "_group"), [*keys, "_chunk"], n_hot


def range_lead(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
               hot_rows: int = HOT_KEY_ROWS, chunk_rows: int = CHUNK_ROWS, fraction: float = SAMPLE_FRACTION,
               partitions: int | None = None, keep_chunk: bool = False) -> DataFrame:
    """``lead(value) OVER (PARTITION BY keys ORDER BY order)`` as column ``out``.

    ``order[0]`` is the sequence column; hot keys are chunked on it.  The result
    is range partitioned on (keys, chunk) and sorted by (keys, order) within
    each partition.  ``keep_chunk`` keeps ``_chunk`` and ``_hot`` when some key
    was split, for callers that run further windows on the same layout.
    """
    withc, part, n_hot = chunk_hot_keys(df, keys, order, hot_rows, chunk_rows, fraction)
    order = [*order, "_tie"] if n_hot else order
    if n_hot:
        # The first value of a key's next chunk travels with the rows: it is joined before the
        # range exchange, so the layout below is the same however that join is done.
        heads = (withc.where("_hot").groupBy(*keys, "_chunk")
                 .agg(F.min_by(F.col(value), F.struct(*_cols(order))).alias("_head")))
        heads = heads.select(*keys, "_chunk", F.lead("_head").over(Window.partitionBy(*keys).orderBy("_chunk"))
                             .alias("_next_head"))
        heads_b, _ = sized_broadcast(heads)       # one row per chunk of a hot key
        withc = _join_keys(withc, heads_b, keys, "left", extra=["_chunk"])
    n = _partitions(df, partitions)
    ranged = exchanged(withc, lambda rows: rows.repartitionByRange(n, *part), order[0], part) \
        .sortWithinPartitions(*part, *order)
    ahead = Window.partitionBy(*part).orderBy(*_cols(order))
    if not n_hot:
        return ranged.withColumn(out, F.lead(value).over(ahead))
    # a NULL ahead may be the next row's value: only a chunk's last row takes the next chunk's
    fixed = ranged.withColumns({out: F.lead(value).over(ahead), "_more": F.lead(F.lit(True)).over(ahead)}) \
        .withColumn(out, F.when(F.col("_more"), F.col(out)).otherwise(F.col("_next_head"))) \
        .drop("_next_head", "_more", "_tie")
    return fixed if keep_chunk else fixed.drop("_chunk", "_hot")


def keyed_carry(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                hot_rows: int = HOT_KEY_ROWS, chunk_rows: int = CHUNK_ROWS, fraction: float = SAMPLE_FRACTION,
                include_current: bool = True) -> DataFrame:
    """``last(value, ignorenulls) OVER (PARTITION BY keys ORDER BY order ROWS
    UNBOUNDED PRECEDING)`` as column ``out``: the latest non-null value at or
    before each row, carried forward.  With ``include_current=False`` the frame
    ends at the previous row, which for a never-null ``value`` is ``lag(value)``.

    The window runs per (key, hot-key chunk), so there is one hash exchange
    on those columns (into as many partitions as the input's bytes ask for; no global order is needed, hence no range sampling).  A
    hot key's chunk takes the carry from its earlier chunks out of a small
    table with one row per hot chunk.
    """
    withc, part, n_hot = chunk_hot_keys(df, keys, order, hot_rows, chunk_rows, fraction)
    order = [*order, "_tie"] if n_hot else order
    end = Window.currentRow if include_current else -1
    upto = Window.partitionBy(*part).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, end)
    carried = _dealt(withc, part).withColumn(out, F.last(value, ignorenulls=True).over(upto))
    if not n_hot:
        return carried
    tails = (withc.where(F.col("_hot") & F.col(value).isNotNull()).groupBy(*keys, "_chunk")
             .agg(F.max_by(F.col(value), F.struct(*_cols(order))).alias("_tail")))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # every chunk of a hot key, so a chunk without values still finds its carry
    chunks = withc.where("_hot").select(*keys, "_chunk").distinct()
    carry = _join_keys(chunks, tails, keys, "left", extra=["_chunk"]) \
        .select(*keys, "_chunk", F.last("_tail", ignorenulls=True).over(before).alias("_carry"))
    carry_b, _ = sized_broadcast(carry)       # one row per chunk of a hot key
    fixed = _join_keys(carried, carry_b, keys, "left", extra=["_chunk"])
    return fixed.withColumn(out, F.coalesce(F.col(out), F.col("_carry"))).drop("_chunk", "_hot", "_tie", "_carry")


def number_in_place(df: DataFrame, name: str, order: Sequence[str] | None = None) -> DataFrame:
    """Dense row numbers in the frame's current global order: partitions in
    range order, rows in their order within each partition.

    Each row gets its partition id and place; the frame is written once (so the
    numbers and the per-partition counts come from one materialisation); the
    number is the prefix offset of the partition (a table with one row per
    partition, broadcast) plus the row's place.  When ``order`` names the sort
    columns, the offsets table also checks that partition ranges ascend and
    do not overlap, so a layout broken by an unexpected shuffle raises instead
    of numbering wrongly.
    """
    tagged = df.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    stored = cut_lineage(tagged, "numbered")
    aggs = [F.count(F.lit(1)).alias("_n")]
    if order:
        aggs += [F.min(F.struct(*_cols(order))).alias("_lo"), F.max(F.struct(*_cols(order))).alias("_hi")]
    counts = stored.groupBy("_pid").agg(*aggs)
    ordered = Window.orderBy("_pid")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            *([F.lag("_hi").over(ordered).alias("_prev_hi"), "_lo"] if order else []))
    if order:
        offsets = offsets.where(F.assert_true(F.col("_prev_hi").isNull() | (F.col("_prev_hi") < F.col("_lo")),
                                              F.lit("partitions are not in range order")).isNull()) \
            .drop("_prev_hi", "_lo")
    # one row per partition, written once: every later read of the numbered table
    # joins it without recounting; as many rows as the stage had tasks, so always small
    offsets = F.broadcast(cut_lineage(offsets, "offsets"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return stored.join(offsets, "_pid") \
        .withColumn(name, (F.col("_off") + local + 1).cast("long")) \
        .drop("_pid", "_mid", "_off")


def global_row_number(df: DataFrame, order: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` without a single-partition sort:
    sampled range partitioning (balanced even when one key dominates), a sort
    within partitions, then :func:`number_in_place`.  ``order`` must be unique
    for a deterministic result."""
    ranged = df.repartitionByRange(_partitions(df, partitions), *order).sortWithinPartitions(*order)
    return number_in_place(ranged, name, order)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order_desc`` (columns given descending)."""
    ordering = [F.col(c).desc() if isinstance(c, str) else c for c in order_desc]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
