"""Session helpers: defaults for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL_CKPT: dict[str, str] = {}
CODEC = "zstd"                              # of intermediate tables: about half of what the default writes
RELEASE_BYTES = 32 << 20                    # a stored table from this size on has the shuffles behind it removed at once
_TABLES: dict[str, list[str]] = {}          # intermediate tables by session, for release_tables


def build_session(master: str = "local[8]", app: str = "tessera", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session used by tests and bench.  On a cluster the caller's session is used as is."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder; only a local-mode session (tests) gets a
    private temporary folder when the setting is absent.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        conf = _LOCAL_CKPT.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame, name: str = "t") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read
    it back: the lineage is cut, the rows survive executor loss, and later plans
    get file statistics, column pruning and filter pushdown on it."""
    return materialize(df, name)[0]


def materialize(df: DataFrame, name: str = "t") -> tuple[DataFrame, int]:
    """Write once, counting the rows on the write itself (no second job)."""
    out, n, _ = materialize_sized(df, name)
    return out, n


def materialize_sized(df: DataFrame, name: str = "t") -> tuple[DataFrame, int, int]:
    """Write once; return the table read back, its row count (observed on the
    write) and its size in bytes on storage (from the file system, no job)."""
    out, seen, size = _stored(df, name, [F.count(F.lit(1)).alias("n")])
    return out, int(seen["n"]), size


def materialize_observed(df: DataFrame, name: str, metrics: list[Column]) -> tuple[DataFrame, dict]:
    """Write once; return the table read back and the aggregates ``metrics`` by their names, observed on the write."""
    return _stored(df, name, metrics)[:2]


def _stored(df: DataFrame, name: str, metrics: list[Column]) -> tuple[DataFrame, dict, int]:
    spark = df.sparkSession
    path, seen = _write_table(df, name, metrics)
    table, size = spark.read.parquet(path), stored_bytes(spark, path)
    if size >= RELEASE_BYTES:
        release_shuffles(spark)
    return table, seen, size


def _write_table(df: DataFrame, name: str, metrics: list[Column]) -> tuple[str, dict]:
    spark = df.sparkSession
    path = scratch_path(spark, "tables", f"{name}-{uuid.uuid4().hex}")
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(path)
    obs = Observation(f"rows_{uuid.uuid4().hex[:12]}")
    df.observe(obs, *metrics).write.mode("error").option("compression", CODEC).parquet(path)
    return path, obs.get


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark's cleaner remove the shuffle files of finished jobs, which else stay on the executors' disks until
    the driver happens to collect its garbage.  Shuffles that a live frame still uses are kept."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_table(table: DataFrame) -> None:
    """Remove an intermediate table that :func:`cut_lineage` wrote.  Frames on it can't be read afterwards."""
    spark = table.sparkSession
    written = _TABLES.get(spark.sparkContext.applicationId, [])
    folders = {unquote(f).rsplit("/", 1)[0] for f in table.inputFiles()}
    for path in [p for p in written if any(f.endswith(p[p.rindex("/tables/"):]) for f in folders)]:
        _delete(spark, path)
        written.remove(path)


def release_tables(spark: SparkSession) -> int:
    """Remove the intermediate tables that this session wrote; returns how many.  Frames on them can't be
    read afterwards."""
    paths = _TABLES.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def folder_stamp(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the entries of a folder (one listing on the driver)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return "|".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in found))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` on its file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def input_bytes(df: DataFrame) -> int:
    """Stored bytes of the files that ``df`` reads (one listing per folder, no job); 0 where it reads none."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folders: dict[str, set[str]] = {}
    for f in df.inputFiles():
        folder, name = unquote(f).rsplit("/", 1)
        folders.setdefault(folder, set()).add(name)
    total = 0
    for folder, names in folders.items():
        p = jvm.org.apache.hadoop.fs.Path(folder)
        total += sum(s.getLen() for s in p.getFileSystem(conf).listStatus(p) if s.getPath().getName() in names)
    return total


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])
