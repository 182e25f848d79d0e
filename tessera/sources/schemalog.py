"""Schema of a growing Parquet source, kept in a log, so that a run opens only footers of files it has not seen.

Every version of the log is one folder ``version=<n>`` with a row per file that was new then (path, length,
modification time) and one row (no path) with the schema of all files so far.  A version counts once its write is
committed (``_SUCCESS``); a run that died is overwritten by the next.  One run at a time writes a log, as with a
stream's checkpoint.

Schemas grow: new columns come after the known ones, and a column whose files have different types takes the
narrowest type that holds both without loss, where Parquet readers can widen to it.  Types that contradict each
other raise before anything is loaded; such sources are for :func:`~tessera.sources.ingest.load_rescued`.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.rescue import file_layouts

ENTRY = "path string, length long, modified timestamp, schema string"

# narrower type: types that hold all its values and that a Parquet column of it can be read as
WIDER = {
    T.ByteType(): (T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()),
    T.ShortType(): (T.IntegerType(), T.LongType(), T.DoubleType()),
    T.IntegerType(): (T.LongType(), T.DoubleType()),
    T.FloatType(): (T.DoubleType(),),
    T.DateType(): (T.TimestampNTZType(),),
}


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds both, None if there is none.  Structs and lists are widened inside."""
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        try:
            return grown(a, b)
        except ValueError:
            return None
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = wider_type(a.elementType, b.elementType)
        return inner and T.ArrayType(inner, True)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else None
    if a.simpleString() == b.simpleString():
        return a
    held = [t for t in (a, *WIDER.get(a, ())) if t in (b, *WIDER.get(b, ()))]
    return held[0] if held else None


def grown(known: T.StructType, new: T.StructType) -> T.StructType:
    """``known`` with the columns of ``new``: wider types where they differ, columns not known so far at the
    end, all nullable.  Names match without regard to case and keep the spelling known first."""
    fields = {f.name.lower(): T.StructField(f.name, f.dataType, True, f.metadata) for f in known}
    for f in new:
        have = fields.get(f.name.lower())
        dtype = f.dataType if have is None else wider_type(have.dataType, f.dataType)
        if dtype is None:
            raise ValueError(f"column {f.name!r} is {have.dataType.simpleString()} in earlier files and "
                             f"{f.dataType.simpleString()} in others")
        fields[f.name.lower()] = T.StructField(have.name if have else f.name, dtype, True, (have or f).metadata)
    return T.StructType(list(fields.values()))


def files_schema(spark: SparkSession, files: list[str]) -> T.StructType | None:
    """The schema that holds all rows of ``files`` (footers are read by Spark jobs); None without files."""
    layouts, unreadable = file_layouts(spark, files)
    if unreadable:
        raise ValueError(f"no readable footer: {', '.join(unreadable[:5])} ({len(unreadable)} files)")
    return reduce(grown, [s for s, _ in sorted(layouts, key=lambda g: min(g[1]))], T.StructType()) if layouts else None


def list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Path, length and modification time of the files; their contents are not read."""
    listing = "path string, modificationTime timestamp, length long, content binary"
    return spark.read.format("binaryFile").schema(listing).option("pathGlobFilter", glob) \
        .option("recursiveFileLookup", "false").load(path) \
        .select("path", "length", F.col("modificationTime").alias("modified"))


def _versions(spark: SparkSession, log: str) -> list[int]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{log}/version=*/_SUCCESS")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(int(st.getPath().getParent().getName().split("=")[1]) for st in found or [])


def logged(spark: SparkSession, log: str) -> tuple[DataFrame, T.StructType | None, int]:
    """The files of the log, the schema of all of them (None in an empty log) and its last version (0 if empty)."""
    done = _versions(spark, log)
    if not done:
        return spark.createDataFrame([], ENTRY), None, 0
    entries = spark.read.schema(ENTRY).parquet(*[f"{log}/version={v}" for v in done])
    last = spark.read.schema(ENTRY).parquet(f"{log}/version={done[-1]}").where("path is null").first()
    return entries.where("path is not null"), T.StructType.fromJson(json.loads(last.schema)), done[-1]


def source_schema(spark: SparkSession, path: str, glob: str, log: str) -> T.StructType | None:
    """The schema of all files of a source, seen ones by the log; None for a source that never had files.

    Only the footers of files that the log does not have with their length and time are opened.  New
    paths reach the driver, which lists them in any case; the log itself is compared as a join."""
    known, schema, version = logged(spark, log)
    keys = ["path", "length", "modified"]
    new = list_files(spark, path, glob).join(known.select(*keys), keys, "left_anti").collect()
    if not new:
        return schema
    found = files_schema(spark, [r.path for r in new])
    schema = grown(schema, found) if schema else grown(T.StructType(), found)
    rows = [(r.path, r.length, r.modified, None) for r in new] + [(None, None, None, schema.json())]
    spark.createDataFrame(rows, ENTRY).write.mode("overwrite").parquet(f"{log}/version={version + 1}")
    return schema
