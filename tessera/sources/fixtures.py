"""Adapters that turn the given tables into the warehouse's staged inputs.

The warehouse expects staged order headers and details with a change feed, an
audit log and a lineage edge table.  These adapters derive all of them from the
given tables with column expressions only (one scan each, no shuffle), so their
work grows with the tables.  Dirty rows (NULL keys, negative totals, NULL event
times) are planted by fixed arithmetic on the business key: the source tables are
clean, and a quality layer needs something to catch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import load

D18_4 = "decimal(18,4)"


def _dec(c: Column) -> Column:
    return c.cast(D18_4)


def stg_order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged order header in the staging layer's raw types."""
    o = load(spark, sf_dir, "orders")
    k, cust, odate = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    amount = _dec(F.col("o_totalprice"))
    return o.select(
        k.alias("order_id"),
        F.nullif(cust % 40, F.lit(0)).alias("truck_id"),
        (cust % 25).cast("double").alias("location_id"),
        F.when(k % 97 != 0, cust).alias("customer_id"),
        F.when(k % 5 == 0, (k % 7).cast("string")).alias("discount_id"),
        (k % 3).alias("shift_id"),
        ((k % 3) * 28800000).cast("int").alias("shift_start_time"),
        ((k % 3) * 28800000 + 28799000).cast("int").alias("shift_end_time"),
        F.col("o_orderpriority").alias("order_channel"),
        F.when(k % 89 != 0, odate).alias("order_ts"),
        F.timestamp_add("SECOND", k % 900, odate).cast("string").alias("served_ts"),
        F.col("o_orderstatus").alias("order_currency"),
        amount.alias("order_amount"),
        _dec(amount * F.lit(0.1).cast("decimal(3,1)")).cast("string").alias("order_tax_amount"),
        F.lit(None).cast("string").alias("order_discount_amount"),
        F.when(k % 101 == 0, -amount).otherwise(amount).alias("order_total"),
        odate.alias("load_ts"),
    )


def chg_order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header change feed: every order inserted at version 0, every fourth order
    updated 30 days later (pre- and post-image; every sixteenth into a negative
    total) and every eleventh deleted 60 days later.

    One scan of ``orders``; the change rows are generated per order with
    ``explode`` rather than by re-reading the table once per change kind.
    """
    stg = stg_order_header(spark, sf_dir)
    oid = F.col("order_id")
    kind = F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("_kind")
    rows = stg.select("*", kind).where(
        (F.col("_kind") == 0)
        | (F.col("_kind").isin(1, 2) & (oid % 4 == 0))
        | ((F.col("_kind") == 3) & (oid % 11 == 0))
    )
    kd = F.col("_kind")
    version = F.when(kd == 0, 0).when(kd <= 2, 1).otherwise(2)
    days = F.when(kd == 0, 0).when(kd <= 2, 30).otherwise(60)
    change = (F.when(kd == 0, "insert").when(kd == 1, "update_preimage")
              .when(kd == 2, "update_postimage").otherwise("delete"))
    total = F.when(kd != 2, F.col("order_total")).when(oid % 16 == 0, F.lit(-1).cast(D18_4)) \
        .otherwise(_dec(F.col("order_total") + 1))
    commit_ts = F.timestamp_add("DAY", days, F.col("load_ts"))
    return rows.select(
        *[c for c in stg.columns if c not in ("order_total", "load_ts")],
        total.alias("order_total"),
        "load_ts",
        version.cast("bigint").alias("_commit_version"),
        commit_ts.alias("_commit_timestamp"),
        change.alias("_change_type"),
        commit_ts.alias("SA_CRUDDTS"),
        F.lit("orders").alias("SA_SRC"),
        F.concat(F.lit("v"), version.cast("string")).alias("SA_RUNID"),
    )


def chg_order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail change feed from ``lineitem``.  Repeats of (order, line) are versions
    ordered by ship date; returned lines with quantity above 45 are deletes; every
    211th detail id carries a zero quantity for the quality rules to catch.

    Amounts use exact decimal/integer arithmetic only, so every engine agrees
    to the last digit: the unit price is the line price in cents divided by
    the quantity, floored to a cent.
    """
    li = load(spark, sf_dir, "lineitem")
    price = _dec(F.col("l_extendedprice"))
    cents = F.round(F.col("l_extendedprice") * 100)
    unit = _dec(F.floor(cents / F.col("l_quantity")).cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)"))
    disc = _dec(price * _dec(F.col("l_discount")))
    change = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45), "delete") \
        .otherwise("update_postimage")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_detail_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("menu_item_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.when((F.col("l_orderkey") * 10 + F.col("l_linenumber")) % 211 == 0, F.lit(0))
        .otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        unit.alias("unit_price"),
        price.alias("price"),
        disc.cast("string").alias("order_item_discount_amount"),
        F.col("l_shipdate").alias("order_ts"),
        F.lit(0).cast("bigint").alias("_commit_version"),
        F.col("l_shipdate").alias("_commit_timestamp"),
        change.alias("_change_type"),
        F.col("l_shipdate").alias("SA_CRUDDTS"),
        F.lit("lineitem").alias("SA_SRC"),
        F.lit("v0").alias("SA_RUNID"),
    )


def chg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event feed keyed by user: ``signup`` inserts, ``error`` deletes, the rest updates."""
    ev = load(spark, sf_dir, "events")
    change = F.when(F.col("event_type") == "error", "delete") \
        .when(F.col("event_type") == "signup", "insert").otherwise("update_postimage")
    return ev.select(
        "user_id", "event_id", "event_type",
        _dec(F.col("value")).alias("value"),
        F.lit(0).cast("bigint").alias("_commit_version"),
        F.col("ts").alias("_commit_timestamp"),
        change.alias("_change_type"),
        F.col("ts").alias("SA_CRUDDTS"),
        F.lit("events").alias("SA_SRC"),
        F.lit("v0").alias("SA_RUNID"),
    )


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage edge table: a forest over ``part`` with three children per node."""
    p = load(spark, sf_dir, "part").where(F.col("p_partkey") > 0)
    node = lambda c: F.concat(F.lit("demo.integration.t"), c.cast("bigint").cast("string"))
    return p.select(
        node(F.floor(F.col("p_partkey") / 3)).alias("source_table_full_name"),
        node(F.col("p_partkey")).alias("target_table_full_name"),
        F.when(F.col("p_size") > 40, "PATH").otherwise("TABLE").alias("entity_type"),
        F.col("p_brand").alias("created_by"),
        F.timestamp_add("DAY", F.col("p_partkey") % 365, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        .alias("created_at"),
    )


# Audit actions per event type.  Fixed values chosen for the fixture.
AUDIT_ACTION = {"signup": "createTable", "click": "getTable", "view": "getTable",
                "purchase": "runSucceeded", "error": "runFailed"}
AUDIT_SERVICE = {"purchase": "pipelines", "error": "jobs"}
AUDIT_SCHEMA = {"signup": "config", "purchase": "datamart"}


def _case(col: Column, mapping: dict[str, str], default: Column | str) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, v) if out is None else out.when(col == k, v))
    return out.otherwise(default)


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit records with the nested layout of an access log:
    ``user_identity`` struct, ``request_params`` map, ``response`` struct."""
    ev = load(spark, sf_dir, "events")
    et = F.col("event_type")
    catalog = F.when(F.col("user_id") % 2 == 0, "DEMO").otherwise("other")
    schema = _case(et, AUDIT_SCHEMA, "integration")
    table = F.when(et == "signup", "pipeline_sources").otherwise(F.concat(et, F.lit("_t")))
    service = _case(et, AUDIT_SERVICE, "unityCatalog")
    params = F.create_map(
        F.lit("catalog_name"), catalog,
        F.lit("schema_name"), schema,
        F.lit("table_name"), table,
        F.lit("full_name_arg"), F.concat_ws(".", F.lower(catalog), schema, table),
        F.lit("job_id"), F.col("user_id").cast("string"),
        F.lit("run_id"), F.col("event_id").cast("string"),
    )
    return ev.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("email")).alias("user_identity"),
        _case(et, AUDIT_ACTION, "getTable").alias("action_name"),
        service.alias("service_name"),
        params.alias("request_params"),
        F.struct(F.when(et == "error", 403).otherwise(200).alias("status_code")).alias("response"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit(".1")).alias("source_ip_address"),
        "props",
    )
