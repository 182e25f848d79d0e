"""Parquet scans: explicit schema with column comments, or inferred; glob filter,
no recursion.  Streams use the same reader with a checkpointed file source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def field(name: str, dtype: T.DataType, comment: str | None = None) -> T.StructField:
    """A nullable field whose comment rides on the field metadata."""
    return T.StructField(name, dtype, True, {"comment": comment} if comment else {})


ORDERS_SCHEMA = T.StructType([
    field("o_orderkey", T.LongType(), "order business key"),
    field("o_custkey", T.LongType(), "customer key"),
    field("o_orderstatus", T.StringType(), "order status, used as currency code"),
    field("o_totalprice", T.DoubleType(), "order total"),
    field("o_orderdate", T.TimestampNTZType(), "order time"),
    field("o_orderpriority", T.StringType(), "order priority, used as channel"),
])

LINEITEM_SCHEMA = T.StructType([
    field("l_orderkey", T.LongType(), "order key"),
    field("l_partkey", T.LongType(), "item key"),
    field("l_suppkey", T.LongType(), "supplier key"),
    field("l_linenumber", T.IntegerType(), "line number"),
    field("l_quantity", T.DoubleType()),
    field("l_extendedprice", T.DoubleType()),
    field("l_discount", T.DoubleType()),
    field("l_tax", T.DoubleType()),
    field("l_returnflag", T.StringType()),
    field("l_linestatus", T.StringType()),
    field("l_shipdate", T.TimestampNTZType(), "ship time"),
])

EVENTS_SCHEMA = T.StructType([
    field("event_id", T.LongType()), field("ts", T.TimestampNTZType()), field("user_id", T.LongType()),
    field("event_type", T.StringType()), field("value", T.DoubleType()), field("props", T.StringType()),
])

SCHEMAS = {"orders": ORDERS_SCHEMA, "lineitem": LINEITEM_SCHEMA, "events": EVENTS_SCHEMA}


def scan(spark: SparkSession, path: str, glob: str | None = None, schema: T.StructType | None = None,
         merge: bool = False) -> DataFrame:
    """Files of one folder matching ``glob`` (not recursive), explicit schema or inferred (``merge``: from
    all files)."""
    reader = spark.read.option("recursiveFileLookup", "false").option("mergeSchema", str(merge).lower())
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def scan_stream(spark: SparkSession, path: str, glob: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental file source: every matching file is read once (tracked by the
    query's checkpoint)."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)
