"""Staging loads driven by a control table: full (overwrite) or incremental
(file stream, each file once), with admin columns and a load report."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.quality import require
from tessera.session import scratch_path
from tessera.sources.rescue import scan_rescued
from tessera.sources.scan import SCHEMAS, scan, scan_stream
from tessera.sources.schemalog import files_schema, list_files, source_schema

CONTROL_SCHEMA = T.StructType([
    T.StructField("source_system", T.StringType(), False),
    T.StructField("source_path", T.StringType(), False),
    T.StructField("file_pattern", T.StringType(), False),
    T.StructField("target_schema", T.StringType(), False),
    T.StructField("target_table", T.StringType(), False),
    T.StructField("file_format", T.StringType(), False),
    T.StructField("is_active", T.BooleanType(), False),
    T.StructField("load_type", T.StringType(), False),
])

LOAD_TYPES = ("full", "incremental")
MODES = (*LOAD_TYPES, "both")


def stage(df: DataFrame, source: str, run_id: str, load_ts: str | Column) -> DataFrame:
    """Add the three staging admin columns; the load time is a parameter so runs repeat."""
    ts = F.lit(load_ts).cast("timestamp_ntz") if isinstance(load_ts, str) else load_ts
    return df.withColumns({"SA_CRUDDTS": ts, "SA_SRC": F.lit(source), "SA_RUNID": F.lit(run_id)})


def control_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, CONTROL_SCHEMA)


def select_loads(control: DataFrame, mode: str, source_system: str | None = None) -> DataFrame:
    """Active control rows for a mode (full, incremental or both); an unknown load
    type in the table stops the run."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    checked = require(control, F.col("load_type").isin(*LOAD_TYPES), "unknown load_type in control table")
    rows = checked.where(F.col("is_active"))
    if source_system:
        rows = rows.where(F.col("source_system") == source_system)
    return rows if mode == "both" else rows.where(F.col("load_type") == mode)


def preview_loads(spark: SparkSession, control: DataFrame, mode: str, source_system: str | None = None
                  ) -> DataFrame:
    """The control rows a run would execute, each with the number of source rows
    its pattern matches: one union of the sources' scans counted in a single
    job (the driver only reads the control rows, one per source)."""
    chosen = select_loads(control, mode, source_system)
    parts = [scan(spark, r.source_path, r.file_pattern).select(F.lit(r.target_table).alias("target_table"))
             for r in chosen.select("source_path", "file_pattern", "target_table").collect()]
    if not parts:
        return chosen.select("source_system", "target_table", "load_type", F.lit(0).cast("bigint").alias("source_rows"))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    counted = union.groupBy("target_table").agg(F.count(F.lit(1)).alias("source_rows"))
    return chosen.select("source_system", "target_table", "load_type").join(counted, "target_table", "left") \
        .select("source_system", "target_table", "load_type",
                F.coalesce(F.col("source_rows"), F.lit(0)).cast("bigint").alias("source_rows"))


def merge_control(target: DataFrame, seed: DataFrame) -> DataFrame:
    """Idempotent seed: insert control rows whose (source_system, target_table) is new."""
    keys = ["source_system", "target_table"]
    return target.unionByName(seed.join(target.select(*keys), keys, "left_anti"))


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    p, fs = _fs(spark, pattern)
    found = fs.globStatus(p)
    return sorted(str(st.getPath().toString()) for st in found) if found else []


def read_target(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A staged table with all columns that any of its files has, in their widest types (older rows have NULL in
    newer columns).  With ``schema``, as a load returns it (``LoadResult.schema``), no footer is opened for it."""
    schema = schema or files_schema(spark, [r.path for r in list_files(spark, path, "*.parquet").select("path").collect()])
    return spark.read.schema(schema).parquet(path)


def _count(spark: SparkSession, path: str) -> int:
    """Rows of a target; one without files has none.  A target that can't be read raises."""
    return spark.read.parquet(path).count() if _glob(spark, f"{path}/*.parquet") else 0


@dataclass
class LoadResult:
    target_table: str
    load_type: str
    rows_before: int
    rows_after: int
    rows_written: int
    path: str
    schema: T.StructType | None = None      # of the whole target, where the load knows it


def load_full(spark: SparkSession, row, target: str, run_id: str, load_ts: str) -> LoadResult:
    """Full load: replace target rows and schema.  The written row count is observed
    on the write itself (one pass)."""
    before = _count(spark, target)
    df = stage(scan(spark, row.source_path, row.file_pattern, SCHEMAS.get(_base(row.file_pattern))),
               row.source_system, run_id, load_ts)
    obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(target)
    written = int(obs.get["rows"])
    return LoadResult(row.target_table, "full", before, written, written, target)


def _generation(spark: SparkSession, target: str, reset: bool) -> int:
    """The target's generation: 0 is the target itself, a reset starts the next one.  It is kept as a
    folder next to the target, so later runs go on where the reset began."""
    seen = [int(p.rsplit("_g", 1)[1]) for p in _glob(spark, f"{target}_g[0-9]*")]
    g = max(seen, default=0) + (1 if reset else 0)
    if reset:
        p, fs = _fs(spark, f"{target}_g{g}")
        fs.mkdirs(p)
    return g


def load_incremental(spark: SparkSession, row, target: str, checkpoint: str, run_id: str, load_ts: str,
                     reset: bool = False) -> LoadResult:
    """Incremental load: a file stream over the pattern, drained with ``availableNow``
    and stopped; the checkpoint makes a rerun add nothing.  ``reset`` starts a new
    generation of target and checkpoint, which later runs keep.  A source without a declared
    schema takes that of all its files together, which a log next to the checkpoint keeps
    (:func:`~tessera.sources.schemalog.source_schema`), so the target's columns and types can grow
    (:func:`read_target`); one that never had files loads nothing."""
    g = _generation(spark, target, reset)
    if g:
        target, checkpoint = f"{target}_g{g}", f"{checkpoint}_g{g}"
    before = _count(spark, target)
    schema = SCHEMAS.get(_base(row.file_pattern)) or \
        source_schema(spark, row.source_path, row.file_pattern, f"{checkpoint}_schemas")
    if schema is None:
        return LoadResult(row.target_table, "incremental", before, before, 0, target)
    stream = stage(scan_stream(spark, row.source_path, row.file_pattern, schema), row.source_system, run_id, load_ts)
    # the rows are counted on the write: a run without a limit of files per trigger is one batch, so that
    # its progress reports are all still there when it ends
    q = (stream.observe("load", F.count(F.lit(1)).alias("rows")).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target))
    q.awaitTermination()
    written = sum({p.batchId: p.observedMetrics["load"]["rows"] for p in q.recentProgress
                   if "load" in p.observedMetrics}.values())
    return LoadResult(row.target_table, "incremental", before, before + written, written, target, stream.schema)


def load_rescued(spark: SparkSession, row, target: str, checkpoint: str, run_id: str, load_ts: str,
                 schema: T.StructType | None = None) -> LoadResult:
    """Incremental load of files that may not fit the declared schema: every row is staged once, with what does
    not fit in ``_rescued_data`` (:func:`~tessera.sources.rescue.scan_rescued`).

    A file stream finds the new files; only their paths go through it (their contents are never read as
    binary), and the paths of a batch reach the driver, which lists them in any case.  Each batch overwrites its
    own folder of the target (``load_batch=<id>``), so a batch that is run again adds nothing."""
    schema = schema or SCHEMAS[_base(row.file_pattern)]
    before = _count(spark, f"{target}/load_batch=*")
    listing = "path string, modificationTime timestamp, length long, content binary"
    paths = spark.readStream.format("binaryFile").schema(listing) \
        .option("pathGlobFilter", row.file_pattern).load(row.source_path).select("path")
    written = []

    def write(batch: DataFrame, batch_id: int) -> None:
        files = [r.path for r in batch.collect()]
        if files:
            obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
            staged = stage(scan_rescued(spark, files, schema), row.source_system, run_id, load_ts)
            staged.observe(obs, F.count(F.lit(1)).alias("rows")) \
                .write.mode("overwrite").parquet(f"{target}/load_batch={batch_id}")
            written.append(int(obs.get["rows"]))

    q = paths.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return LoadResult(row.target_table, "incremental", before, before + sum(written), sum(written), target)


def _base(pattern: str) -> str:
    return pattern.split("*")[0].split(".")[0].lower()


def run_loads(spark: SparkSession, control: DataFrame, mode: str, run_id: str, load_ts: str,
              root: str | None = None, reset: bool = False) -> tuple[DataFrame, list[LoadResult]]:
    """One Spark load job per selected control row; returns the load report.  ``reset`` starts new
    generations of the incremental targets.

    The control table has one row per source, so collecting it to drive the
    loads is bounded by the number of sources, not by data volume.
    """
    root = root or scratch_path(spark, "staging", run_id)
    results = []
    for row in select_loads(control, mode).orderBy("target_table").collect():
        target = f"{root}/{row.target_schema}/{row.target_table}"
        if row.load_type == "full":
            results.append(load_full(spark, row, target, run_id, load_ts))
        else:
            results.append(load_incremental(spark, row, target, f"{root}/_checkpoints/{row.target_table}",
                                            run_id, load_ts, reset))
    report = spark.createDataFrame(
        [(r.target_table, r.load_type, r.rows_before, r.rows_after, r.rows_after - r.rows_before, r.rows_written)
         for r in results],
        "target_table string, load_type string, rows_before long, rows_after long, rows_delta long, "
        "rows_written long")
    return report, results
