"""Rescue of input that does not fit the declared schema: values go to ``_rescued_data``, rows stay.

A declared column whose stored value does not fit its type is NULL, and ``_rescued_data`` (JSON text) keeps the value
under the column's name, next to values of columns that the schema does not declare.  It is NULL for a row that
fits.  A value fits if it is turned into the declared type without loss: text that can be cast, numbers and times
that come back equal after the cast.  Names match without regard to case; a missing column is NULL.

* :func:`scan_rescued` reads Parquet files, each in the types of its own footer.  Files of one layout are read by one
  scan, and a layout with the declared types by the plain scan with all its pushdown.  A file whose footer can't be
  read becomes one row that names it (``_corrupt_file``).
* :func:`rescue_json` does the same for JSON text; a malformed record is kept whole (``_corrupt_record``).
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _common_schema(spark: SparkSession, files: list[str]) -> T.StructType | None:
    """The schema of all the files together (Spark reads the footers in a job); None if types contradict each
    other or a footer can't be read.  Any other failure is raised."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*files).schema
    except (Py4JJavaError, PySparkException) as e:
        if "CANNOT_MERGE_SCHEMAS" in str(e) or "CANNOT_READ_FILE_FOOTER" in str(e):
            return None
        raise


def file_layouts(spark: SparkSession, files: list[str]) -> tuple[list[tuple[T.StructType, list[str]]], list[str]]:
    """Files grouped by layout, and the files without a readable footer.

    All files are tried as one group, and a group without common types is halved.  Producers change a layout at
    a point in time, so files are halved in name order: ``k`` changes among ``n`` files take about ``k log n``
    tries.  Groups with equal schemas are put together again."""
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    unreadable: list[str] = []
    todo = [sorted(files)] if files else []
    while todo:
        part = todo.pop()
        schema = _common_schema(spark, part)
        if schema is not None:
            groups.setdefault(schema.json(), (schema, []))[1].extend(part)
        elif len(part) == 1:
            unreadable += part
        else:
            todo += [part[:len(part) // 2], part[len(part) // 2:]]
    return list(groups.values()), unreadable


def _cast(df: DataFrame, value: Column, to: T.DataType) -> Column | None:
    """``value`` in type ``to``, NULL where it can't be; None for types between which there is no cast."""
    out = value.try_cast(to)
    try:
        df.select(out)
    except AnalysisException:
        return None
    return out


def fit(df: DataFrame, schema: T.StructType, file: Column | None = None) -> DataFrame:
    """The columns of ``schema`` and ``_rescued_data`` of a frame with other types or columns; ``file`` is added
    to what is rescued as ``_file_path``."""
    own = {f.name.lower(): f for f in df.schema}
    out, kept = [], []
    for want in schema:
        have = own.pop(want.name.lower(), None)
        if have is None:
            out.append(F.lit(None).cast(want.dataType).alias(want.name))
            continue
        value = _quoted(have.name)
        if have.dataType.simpleString() == want.dataType.simpleString():
            out.append(value.alias(want.name))
            continue
        cast = _cast(df, value, want.dataType)
        if cast is None:
            fits = F.lit(False)
        elif isinstance(have.dataType, T.StringType) or isinstance(want.dataType, T.StringType):
            fits = cast.isNotNull()
        else:
            back = _cast(df, cast, have.dataType)
            fits = F.lit(False) if back is None else back.eqNullSafe(value)
        out.append((F.lit(None).cast(want.dataType) if cast is None else F.when(fits, cast)).alias(want.name))
        kept.append(F.when(value.isNotNull() & ~fits, value).alias(want.name))
    kept += [_quoted(f.name).alias(f.name) for f in own.values()]
    if not kept:
        return df.select(*out, F.lit(None).cast("string").alias(RESCUED))
    any_kept = reduce(lambda a, b: a | b, (c.isNotNull() for c in kept))
    entry = F.to_json(F.struct(*kept, *([file.alias("_file_path")] if file is not None else [])))
    return df.select(*out, F.when(any_kept, entry).alias(RESCUED))


def scan_rescued(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """The rows of Parquet files in the columns of ``schema``, with what does not fit in ``_rescued_data``.

    No file gives an empty frame.  The plan has one scan per layout, not per file."""
    layouts, unreadable = file_layouts(spark, files)
    parts = []
    for own, paths in layouts:
        # the files of one layout are read in their own types, so that no value is lost before it is looked at
        parts.append(fit(spark.read.schema(own).parquet(*paths), schema, F.col("_metadata.file_path")))
    full = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    if unreadable or not parts:
        nulls = [None] * len(schema)
        lost = spark.createDataFrame([(*nulls, p) for p in unreadable], full)
        parts.append(lost.withColumn(RESCUED, F.to_json(F.struct(F.col(RESCUED).alias("_corrupt_file")))))
    return reduce(DataFrame.unionByName, parts)


def rescue_json(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """``df`` with its JSON column ``text`` replaced by the columns of ``schema`` and ``_rescued_data``.

    NULL and empty text give NULLs; a record that is not a JSON object is kept whole as ``_corrupt_record``.  Nested
    columns hold what could be parsed of them, and the value is rescued too unless it can be written back from
    that.  Works on streams; one projection, no shuffle."""
    raw = _quoted(text)
    record = F.from_json(raw, "map<string,string>")
    wanted = [f.name for f in schema]
    found = df.drop(RESCUED).withColumn(RESCUED, record)
    fields = F.col(RESCUED)

    def typed(f: T.StructField) -> Column:
        value = F.element_at(fields, F.lit(f.name))
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.from_json(value, f.dataType)
        return value.try_cast(f.dataType)

    def fits(f: T.StructField) -> Column:
        if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return typed(f).isNotNull()
        # written back and put in normal form, what was parsed is what stood there
        normal = lambda c: F.to_json(F.try_parse_json(c))
        return normal(F.to_json(typed(f))) == normal(F.element_at(fields, F.lit(f.name)))

    fitting = F.array_compact(F.array(*(F.when(fits(f), F.lit(f.name)) for f in schema)))
    left = F.map_filter(fields, lambda k, v: v.isNotNull() & ~F.array_contains(fitting, k))
    corrupt = F.to_json(F.struct(raw.alias("_corrupt_record")))
    rescued = F.when(F.trim(raw) == "", None).when(fields.isNull() & raw.isNotNull(), corrupt) \
        .when(F.size(left) > 0, F.to_json(left))
    others = [_quoted(c) for c in df.columns if c not in (text, RESCUED, *wanted)]
    return found.select(*others, *(typed(f).alias(f.name) for f in schema), rescued.alias(RESCUED))
