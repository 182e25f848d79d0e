"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import history, quality, star
from tessera.plans import reports
from tessera.plans.entities import DETAIL, EVENTS, HEADER
from tessera.plans.warehouse import Warehouse
from tessera.session import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str, as_written: bool = False):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        mode = star.AS_WRITTEN if as_written else star.CONFORMED
        QUERIES[name] = lambda spark, sf_dir: fn(Warehouse.of(spark, sf_dir, mode))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


# ----------------------------------------------------------- history
@register("tagged_header")
def _tagged_header(w):
    return w.header_tagged


@register("tagged_detail")
def _tagged_detail(w):
    return w.detail_tagged


@register("scd2_header")
def _scd2_header(w):
    return w.dw_header


@register("scd2_detail")
def _scd2_detail(w):
    return w.dw_detail


@register("scd2_events")
def _scd2_events(w):
    return w.dw_events


@register("dwh_header")
def _dwh_header(w):
    return w.dwh_header


@register("dwh_detail")
def _dwh_detail(w):
    return w.dwh_detail


@register("scd2_tracked")
def _scd2_tracked(w):
    return history.scd2(quality.clean(w.events_tagged), EVENTS, track=["event_type"], hashed=True)


@register("scd1_upsert")
def _scd1(w):
    return history.scd1(quality.clean(w.events_tagged), EVENTS)


@register("deleted_keys")
def _deleted(w):
    return history.deleted_keys(w.dwh_header, HEADER)


@register("version_path")
def _version_path(w):
    """Version path of every key with more than one version, numbered in start order."""
    return history.version_path(w.dwh_header, HEADER).select(
        "order_id", "WK_ORDER_HEADER", "WKP_ORDER_HEADER", "WKR_ORDER_HEADER", "order_total",
        "WA_FROMDATE", "WA_UNTODATE", "WA_ISCURR", "version_no")


@register("scd2_refresh")
def _scd2_refresh(w):
    """History rebuilt after more changes: versions known before keep their surrogates."""
    changes = quality.clean(w.events_tagged)
    last_hour = F.date_trunc("hour", changes.agg(F.max("_commit_timestamp")).scalar()).cast("timestamp_ntz")
    early = cut_lineage(history.scd2(changes.where(F.col("_commit_timestamp") < last_hour), EVENTS, hashed=True), "early")
    late = history.scd2(changes, EVENTS, previous=early, hashed=True)
    known = early.select(*EVENTS.keys, "__START_AT", F.col(EVENTS.wk).alias("known_wk"))
    top = F.coalesce(early.agg(F.max(EVENTS.wk)).scalar(), F.lit(0))
    return late.join(known, [*EVENTS.keys, "__START_AT"], "left").select(
        *EVENTS.keys, "event_id", "__START_AT", "__END_AT", F.col("known_wk").isNotNull().alias("was_known"),
        F.coalesce(F.col(EVENTS.wk) == F.col("known_wk"), F.col(EVENTS.wk) > top).alias("number_is_stable"))


# ----------------------------------------------------------- quality
@register("failed_rules")
def _failed_rules(w):
    return w.header_tagged.where(F.size("failed_rules") > 0) \
        .select("order_id", "WA_CRUD", "_commit_timestamp", "failed_rules")


@register("clean_rows")
def _clean_rows(w):
    return quality.clean(w.header_tagged)


@register("quarantine_header")
def _q_header(w):
    return quality.quarantine(w.header_tagged, HEADER)


@register("quarantine_detail")
def _q_detail(w):
    return quality.quarantine(w.detail_tagged, DETAIL)


@register("rule_counts")
def _rule_counts(w):
    return quality.rule_counts(w.header_tagged, HEADER)


@register("rule_counts_on_write")
def _run_counts(w):
    """Every rule of every entity with its violations, counted by the write that stored the rows."""
    return w.run_counts


@register("rule_counts_stream")
def _stream_counts(w):
    """Violations by rule over all micro-batches of the event stream, each counted on the batch's write."""
    counts = _history_stream(w, "counts", EVENTS, 1, "_commit_timestamp").rule_counts
    return counts.groupBy("entity", "rule", "severity").agg(F.sum("input_rows").alias("input_rows"),
                                                            F.sum("violations").alias("violations"))


@register("warn_counts")
def _warn_counts(w):
    return quality.warn_counts(w.header_tagged, HEADER)


@register("triage_by_rule")
def _triage(w):
    return quality.triage(quality.quarantine(w.header_tagged, HEADER), "order_total_non_negative")


@register("row_conservation")
def _conservation(w):
    """Per entity: input changes, clean, quarantined, and whether they add up."""
    parts = []
    for name, tagged in (("order_header", w.header_tagged), ("order_detail", w.detail_tagged),
                         ("user_event", w.events_tagged)):
        parts.append(tagged.agg(
            F.lit(name).alias("entity"), F.count(F.lit(1)).alias("input_rows"),
            F.count_if(F.size("failed_rules") == 0).alias("clean_rows"),
            F.count_if(F.size("failed_rules") > 0).alias("quarantined_rows")))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.withColumn("conserved", F.col("clean_rows") + F.col("quarantined_rows") == F.col("input_rows"))


# ----------------------------------------------------------- star schema
for _dim in ("truck", "location", "customer", "currency", "order_channel", "discount", "shift", "menu_item", "date"):
    register(f"dim_{_dim}")(lambda w, _d=_dim: getattr(w, f"dim_{_d}"))


@register("fct_order")
def _fct_order(w):
    return w.fct_order


@register("fct_sales_line")
def _fct_sales_line(w):
    return w.fct_sales_line


@register("sales_line")
def _sales_line(w):
    return w.sales_line


@register("monthly_revenue_by_currency")
def _r1(w):
    return reports.monthly_revenue_by_currency(w)


@register("monthly_revenue_by_currency_as_written", as_written=True)
def _r1_aw(w):
    return reports.monthly_revenue_by_currency(w)


@register("top_trucks_by_revenue")
def _r2a(w):
    return reports.top_trucks_by_revenue(w)


@register("top_locations_by_revenue")
def _r2b(w):
    return reports.top_locations_by_revenue(w)


@register("kpi_totals")
def _r3(w):
    return reports.kpi_totals(w)


for _name in ("fact_listing", "orders_by_truck_key", "orders_by_truck", "monthly_trend_by_key", "fact_for_one_truck",
              "sales_by_hour_and_day", "best_truck_last_week", "hourly_two_trucks", "avg_order_value_by_location",
              "best_item_on_sunday", "daily_sales_by_truck", "daily_sales_by_location", "date_roles",
              "conformed_dim_lookup", "fct_temporal_left", "fact_incremental"):
    register(_name)(lambda w, _n=_name: getattr(reports, _n)(w))


@register("dim_scd2")
def _dim_scd2(w):
    return star.dim_scd2(w.dwh_header, ["order_id"], "WK_ORDER_HEADER", "WKR_ORDER_HEADER", "MK_ORDER",
                         ["truck_id", "order_currency", "order_total"])


@register("scd1_dim_grouped")
def _scd1_grouped(w):
    """One dimension on its own: the latest row of each value by rank, joined to its grouped dates."""
    return star.dim_scd1(w.dwh_header, "customer_id", "WKR_ORDER_HEADER", "MK_CUSTOMER")


def _loaded_before_last_month(w):
    """The order fact, and the start of the last month in which rows were loaded."""
    fact = w.fct_order
    return fact, F.date_trunc("month", fact.agg(F.max("WA_CRUDDTS")).scalar()).cast("timestamp_ntz")


@register("fact_append")
def _fact_append(w):
    """The fact as loaded before the last month, then everything loaded since: equals the whole fact."""
    fact, mark = _loaded_before_last_month(w)
    old = cut_lineage(fact.where(F.col("WA_CRUDDTS") < mark), "fact_old")
    return star.fact_increment(fact, old, "append", watermark="WA_CRUDDTS", keys=["order_id"])


@register("fact_merge")
def _fact_merge(w):
    """Orders loaded in the last month replace their stale rows by key, however old the order is."""
    fact, mark = _loaded_before_last_month(w)
    late = F.col("WA_CRUDDTS") >= mark
    stale = fact.withColumn("order_total", F.when(late, F.lit(0)).otherwise(F.col("order_total")).cast("decimal(38,4)"))
    return star.fact_increment(fact.where(late), stale, "merge", keys=["order_id"])


@register("fact_merge_partitions")
def _fact_merge_partitions(w):
    """As ``fact_merge``, on a stored fact by month of order: only the months of the merged rows are written."""
    import uuid
    from tessera.operators.partitions import merge_partitions, month_of, read_partitioned, write_partitioned
    from tessera.session import scratch_path
    fact, mark = _loaded_before_last_month(w)
    late, month = F.col("WA_CRUDDTS") >= mark, month_of(F.col("order_ts"))
    path = scratch_path(w.spark, "datamart", f"fct_order_{uuid.uuid4().hex}")
    stale = F.when(late, F.lit(0)).otherwise(F.col("order_total")).cast("decimal(38,4)")
    write_partitioned(fact.withColumn("order_total", stale), path, month)
    merge_partitions(fact.where(late), path, ["order_id"], month)
    return read_partitioned(w.spark, path)


@register("fact_overwrite")
def _fact_overwrite(w):
    """The fact rebuilt in full."""
    fact, mark = _loaded_before_last_month(w)
    return star.fact_increment(fact, fact.where(F.col("WA_CRUDDTS") < mark), "overwrite")


# ----------------------------------------------------------- plain (spark, sf_dir) queries
def query(name: str):
    def deco(fn: Query):
        QUERIES[name] = fn
        return fn
    return deco


LOAD_TS = "2024-06-01 00:00:00"   # load time parameter of the staging runs
RUN_ID = "run-0001"


@query("scan_explicit_schema")
def _scan_explicit(spark, sf_dir):
    from tessera.sources.scan import ORDERS_SCHEMA, scan
    return scan(spark, sf_dir, "orders*.parquet", ORDERS_SCHEMA)


@query("scan_inferred")
def _scan_inferred(spark, sf_dir):
    from tessera.sources.scan import scan
    return scan(spark, sf_dir, "customer*.parquet")


@query("stage_admin_columns")
def _stage(spark, sf_dir):
    from tessera.sources.ingest import stage
    from tessera.sources.scan import ORDERS_SCHEMA, scan
    return stage(scan(spark, sf_dir, "orders*.parquet", ORDERS_SCHEMA), "objectstore", RUN_ID, LOAD_TS)


def _control(spark, sf_dir):
    from tessera.sources.ingest import control_table
    # Control rows: one per staged source (fixed configuration of the staging run).
    return control_table(spark, [
        ("objectstore", sf_dir, "orders*.parquet", "staging", "stg_orders", "parquet", True, "full"),
        ("objectstore", sf_dir, "lineitem*.parquet", "staging", "stg_lineitem", "parquet", True, "incremental"),
        ("objectstore", sf_dir, "events*.parquet", "staging", "stg_events", "parquet", True, "incremental"),
        ("objectstore", sf_dir, "part*.parquet", "staging", "stg_part", "parquet", False, "full"),
    ])


def _run(spark, sf_dir, mode):
    import uuid
    from tessera.session import scratch_path
    from tessera.sources.ingest import run_loads
    return run_loads(spark, _control(spark, sf_dir), mode, RUN_ID, LOAD_TS,
                     root=scratch_path(spark, "staging", uuid.uuid4().hex))


@query("control_select")
def _control_select(spark, sf_dir):
    """Active control rows of both modes with the source rows each load would read."""
    from tessera.sources.ingest import preview_loads
    return preview_loads(spark, _control(spark, sf_dir), "both")


@query("time_of_day_format")
def _time_of_day(spark, sf_dir):
    """Shift times kept as milliseconds since midnight, shown as HH:mm:ss and back."""
    from tessera.functions.timeofday import hms_to_seconds, millis_to_hms
    from tessera.sources.fixtures import stg_order_header
    stg = stg_order_header(spark, sf_dir)
    return stg.select("order_id", millis_to_hms("shift_start_time").alias("shift_start"),
                      millis_to_hms("shift_end_time").alias("shift_end")) \
        .withColumn("shift_seconds", hms_to_seconds("shift_end") - hms_to_seconds("shift_start"))


@query("ingest_full")
def _ingest_full(spark, sf_dir):
    _, results = _run(spark, sf_dir, "full")
    return spark.read.parquet(results[0].path)


@query("ingest_incremental")
def _ingest_incremental(spark, sf_dir):
    _, results = _run(spark, sf_dir, "incremental")
    return spark.read.parquet(next(r.path for r in results if r.target_table == "stg_lineitem"))


@query("ingest_reset")
def _ingest_reset(spark, sf_dir):
    """Incremental load, reset, and a plain run after it: the new generation holds every row once."""
    import uuid
    from tessera.session import scratch_path
    from tessera.sources.ingest import read_target, run_loads
    root = scratch_path(spark, "staging", uuid.uuid4().hex)
    for reset in (False, True, False):
        _, results = run_loads(spark, _control(spark, sf_dir), "incremental", RUN_ID, LOAD_TS, root=root, reset=reset)
    return read_target(spark, next(r.path for r in results if r.target_table == "stg_events"))


@query("ingest_grown_schema")
def _ingest_grown(spark, sf_dir):
    """A source without a declared schema whose later files have one more column."""
    import uuid
    from tessera.session import scratch_path
    from tessera.sources.ingest import control_table, read_target, run_loads
    root = scratch_path(spark, "staging", uuid.uuid4().hex)
    parts = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey", "s_acctbal")
    control = control_table(spark, [("erp", f"{root}/drop", "*.parquet", "staging", "stg_supplier", "parquet", True, "incremental")])
    early = F.col("s_acctbal") < 0
    for arrival in (parts.where(early).drop("s_acctbal"), parts.where(~early)):
        arrival.write.mode("append").parquet(f"{root}/drop")
        _, results = run_loads(spark, control, "incremental", RUN_ID, LOAD_TS, root=root)
    return read_target(spark, results[0].path)


@query("ingest_widened_types")
def _ingest_widened(spark, sf_dir):
    """A source whose types widen over three arrivals and one run without any; its schema comes from the log."""
    import uuid
    from tessera.session import scratch_path
    from tessera.sources.ingest import control_table, read_target, run_loads
    root = scratch_path(spark, "staging", uuid.uuid4().hex)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    control = control_table(spark, [("erp", f"{root}/drop", "*.parquet", "staging", "stg_paid", "parquet", True, "incremental")])
    third = F.col("o_orderkey") % 3
    arrivals = [
        orders.where(third == 0).selectExpr("o_orderkey", "cast(o_custkey % 1000 as smallint) as branch",
                                            "cast(round(o_totalprice) as decimal(12,0)) as paid"),
        orders.where(third == 1).selectExpr("o_orderkey", "cast(o_custkey % 1000 as smallint) as branch",
                                            "cast(o_totalprice as decimal(14,2)) as paid"),
        orders.where(third == 2).selectExpr("o_orderkey", "o_custkey % 1000 as branch", "cast(o_totalprice as decimal(14,2)) as paid",
                                            "o_orderstatus as currency"),
        None,
    ]
    for arrival in arrivals:
        if arrival is not None:
            arrival.write.mode("append").parquet(f"{root}/drop")
        _, results = run_loads(spark, control, "incremental", RUN_ID, LOAD_TS, root=root)
    return read_target(spark, results[0].path, results[0].schema)


@query("load_report")
def _load_report(spark, sf_dir):
    report, _ = _run(spark, sf_dir, "both")
    return report


@query("change_feed_from_version")
def _cf_from(spark, sf_dir):
    from tessera.operators.changes import changes_from
    return changes_from(Warehouse.of(spark, sf_dir).header_feed, 1)


@query("cdc_adapter")
def _cdc_adapter(spark, sf_dir):
    """A CDC table with native metadata (op code, sequence, op time) mapped to the feed shape."""
    from tessera.operators.changes import cdc_adapter
    feed = Warehouse.of(spark, sf_dir).header_feed
    code = (F.when(F.col("_change_type") == "insert", "I").when(F.col("_change_type") == "update_postimage", "U")
            .when(F.col("_change_type") == "delete", "D").otherwise("B"))
    native = feed.select("order_id", "order_currency", "order_total", code.alias("op"),
                         F.col("_commit_version").alias("lsn"), F.col("_commit_timestamp").alias("op_ts"))
    return cdc_adapter(native, source="cdc")


@query("unix_time_text")
def _unix_time_text(spark, sf_dir):
    """Event times as milliseconds since 1970, shown as text again."""
    from tessera.functions.timeofday import unix_millis_text
    from tessera.sources.tables import load
    ev = load(spark, sf_dir, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("millis"))
    return ev.select("event_id", unix_millis_text("millis").alias("shown_at"),
                     unix_millis_text("millis", "HH:mm:ss").alias("time_of_day"))


@query("rescued_rows")
def _rescued(spark, sf_dir):
    """Malformed JSON kept as text in a corrupt-record column instead of failing the read.
    The fixture cuts the payload of every 50th event to three characters."""
    from tessera.sources.tables import load
    ev = load(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 50 == 0, F.substring("props", 1, 3)).otherwise(F.col("props"))
    parsed = F.from_json(raw, "k INT, _corrupt_record STRING",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return ev.select("event_id", parsed.alias("p")).select("event_id", "p.k", "p._corrupt_record")


@query("rescued_files")
def _rescued_files(spark, sf_dir):
    """Three arrivals of the orders under one declared schema: as declared, the total as text with one more
    column, the customer as a number with fractions.  Each run loads the new files; no row is lost."""
    import uuid
    from tessera.session import scratch_path
    from tessera.sources.ingest import control_table, load_rescued, read_target
    from tessera.sources.rescue import RESCUED
    from tessera.sources.scan import ORDERS_SCHEMA
    from tessera.sources.tables import load
    root = scratch_path(spark, "staging", uuid.uuid4().hex)
    orders = load(spark, sf_dir, "orders").select(*ORDERS_SCHEMA.names)
    key = F.col("o_orderkey")
    total = F.when(key % 50 == 1, "n/a").otherwise(F.round("o_totalprice").cast("long").cast("string"))
    customer = F.col("o_custkey") + F.when(key % 50 == 2, 0.5).otherwise(0.0)
    arrivals = (orders, orders.withColumns({"o_totalprice": total, "note": F.concat(F.lit("note "), key)}),
                orders.withColumn("o_custkey", customer))
    row = control_table(spark, [("erp", f"{root}/drop", "*.parquet", "staging", "stg_orders", "parquet", True,
                                 "incremental")]).first()
    for i, arrival in enumerate(arrivals):
        arrival.where(key % 3 == i).write.mode("append").parquet(f"{root}/drop")
        load_rescued(spark, row, f"{root}/stg_orders", f"{root}/ck", RUN_ID, LOAD_TS, ORDERS_SCHEMA)
    kept = lambda name: F.get_json_object(RESCUED, f"$.{name}").alias(f"rescued_{name}")
    return read_target(spark, f"{root}/stg_orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "SA_RUNID",
        F.col(RESCUED).isNotNull().alias("has_rescued"), kept("o_totalprice"), kept("o_custkey"), kept("note"))


@query("rescued_json")
def _rescued_json(spark, sf_dir):
    """Event payloads under a declared schema, some cut off, some with a word for the number or one more field."""
    from pyspark.sql import types as T
    from tessera.sources.rescue import rescue_json
    from tessera.sources.tables import load
    ev = load(spark, sf_dir, "events")
    kind = F.col("event_id") % 50
    payload = F.when(kind == 0, F.substring("props", 1, 3)).when(kind == 1, F.lit('{"k": "many"}')) \
        .when(kind == 2, F.concat(F.lit('{"k": 2, "from": "'), "event_type", F.lit('"}'))).otherwise(F.col("props"))
    return rescue_json(ev.select("event_id", payload.alias("payload")), "payload",
                       T.StructType([T.StructField("k", T.IntegerType())]))


@query("clustered_write")
def _clustered(spark, sf_dir):
    import uuid
    from tessera.operators.layout import clustered_write
    from tessera.session import scratch_path
    path = scratch_path(spark, "datamart", f"fct_sales_line_{uuid.uuid4().hex}")
    clustered_write(Warehouse.of(spark, sf_dir).fct_sales_line, path,
                    ["MK_TRUCK", "MK_LOCATION", "MK_DATE", "MK_CURRENCY"])
    return spark.read.parquet(path)


@query("clustered_pruning")
def _clustered_pruning(spark, sf_dir):
    """The line fact written clustered: for the commonest value of each key, the rows that a filter on this key
    alone finds, and whether the files' ranges let it open at most half of the files."""
    import uuid
    from tessera.operators.layout import clustered_write, file_ranges, files_opened
    from tessera.session import scratch_path
    path = scratch_path(spark, "datamart", f"fct_sales_line_{uuid.uuid4().hex}")
    keys = ["MK_TRUCK", "MK_LOCATION", "MK_DATE", "MK_CURRENCY"]
    clustered_write(Warehouse.of(spark, sf_dir).fct_sales_line, path, keys)
    written = spark.read.parquet(path)
    found = None
    for k in keys:
        common = written.where(F.col(k).isNotNull()).groupBy(k).agg(F.count(F.lit(1)).alias("line_count")) \
            .orderBy(F.desc("line_count"), k).limit(1) \
            .select(F.lit(k).alias("key"), F.col(k).cast("string").alias("value"), "line_count")
        found = common if found is None else found.unionByName(common)
    found = cut_lineage(found, "probes")                    # one row per key
    opened = files_opened(cut_lineage(file_ranges(written, keys), "ranges"), found)
    return found.join(opened, ["key", "value"]).select(
        "key", "value", "line_count", (2 * F.col("opened") <= F.col("files")).alias("opens_at_most_half"))


@query("wide_line_clustered")
def _wide_clustered(spark, sf_dir):
    """The wide line table written clustered, so reads by truck, location or date skip files."""
    import uuid
    from tessera.operators.layout import clustered_write
    from tessera.session import scratch_path
    path = scratch_path(spark, "datamart", f"sales_line_{uuid.uuid4().hex}")
    clustered_write(cut_lineage(Warehouse.of(spark, sf_dir).sales_line, "sales_line"), path, ["truck_id", "location_id", "line_ts"])
    return spark.read.parquet(path)


@query("param_query")
def _param(spark, sf_dir):
    """Named parameters bound into SQL text."""
    from tessera.sources.tables import load
    load(spark, sf_dir, "orders").createOrReplaceTempView("orders_src")
    return spark.sql("SELECT o_orderstatus, COUNT(*) AS orders, "
                     "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue "
                     "FROM orders_src WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) AND o_orderpriority = :prio "
                     "GROUP BY o_orderstatus",
                     args={"since": "1998-01-01 00:00:00", "prio": "1-URGENT"})


# ----------------------------------------------------------- table changes
def _stg(w):
    from tessera.sources.fixtures import stg_order_header
    return stg_order_header(w.spark, w.sf_dir)


_STG = ["order_id", "truck_id", "location_id", "customer_id", "discount_id", "shift_id", "shift_start_time",
        "shift_end_time", "order_channel", "order_ts", "served_ts", "order_currency", "order_amount",
        "order_tax_amount", "order_discount_amount", "order_total", "load_ts"]


# The two rows the demo injects into staging with INSERT VALUES (a
# negative total, which quarantine must catch, and a NULL key, which stops the run).
INJECTED_SQL = """
SELECT * FROM VALUES
  (CAST(900000001 AS BIGINT), CAST(1 AS BIGINT), CAST(1.0 AS DOUBLE), CAST(42 AS BIGINT), CAST(NULL AS STRING),
   CAST(1 AS BIGINT), 28800000, 57599000, '1-URGENT', TIMESTAMP_NTZ '1998-08-02 00:00:00', '1998-08-02 00:05:00',
   'O', CAST(-5 AS DECIMAL(18,4)), '0.5000', CAST(NULL AS STRING), CAST(-5 AS DECIMAL(18,4)),
   TIMESTAMP_NTZ '1998-08-02 00:00:00'),
  (CAST(NULL AS BIGINT), CAST(2 AS BIGINT), CAST(2.0 AS DOUBLE), CAST(43 AS BIGINT), CAST(NULL AS STRING),
   CAST(2 AS BIGINT), 57600000, 86399000, '2-HIGH', TIMESTAMP_NTZ '1998-08-03 00:00:00', '1998-08-03 00:05:00',
   'F', CAST(10 AS DECIMAL(18,4)), '1.0000', CAST(NULL AS STRING), CAST(10 AS DECIMAL(18,4)),
   TIMESTAMP_NTZ '1998-08-03 00:00:00')
AS t(order_id, truck_id, location_id, customer_id, discount_id, shift_id, shift_start_time, shift_end_time,
     order_channel, order_ts, served_ts, order_currency, order_amount, order_tax_amount, order_discount_amount,
     order_total, load_ts)"""


@register("inline_rows")
def _inline_rows(w):
    """Staged headers with literal rows appended (``INSERT ... VALUES`` / ``UNION ALL``)."""
    return _stg(w).unionByName(w.spark.sql(INJECTED_SQL))


@register("merge_insert_only")
def _merge(w):
    from tessera.operators.changes import as_of, merge_insert_only
    target = as_of(w.header_feed, ["order_id"], version=2).select(*_STG)
    return merge_insert_only(target, _stg(w), ["order_id"])


@register("update_where")
def _update(w):
    from tessera.operators.changes import update_where
    return update_where(_stg(w), F.col("order_currency") == "F",
                        {"order_total": (F.col("order_total") + 1).cast("decimal(18,4)")})


@register("delete_where")
def _delete(w):
    from tessera.operators.changes import delete_where
    return delete_where(_stg(w), F.col("order_ts") < F.lit("1996-01-01").cast("timestamp_ntz"))


@register("as_of_version")
def _as_of_v(w):
    from tessera.operators.changes import as_of
    return as_of(w.header_feed, ["order_id"], version=1).select(*_STG, "_commit_version")


@register("as_of_timestamp")
def _as_of_ts(w):
    from tessera.operators.changes import as_of
    return as_of(w.header_feed, ["order_id"], ts="1998-01-01 00:00:00").select(*_STG, "_commit_version")


@register("version_history")
def _vh(w):
    from tessera.operators.changes import version_history
    return version_history(w.header_feed)


# ----------------------------------------------------------- change data
@register("cdc_filter")
def _cdc_filter(w):
    from tessera.operators.changes import cdc_filter, crud_code
    return cdc_filter(w.header_feed).select("order_id", "_commit_version", "_change_type",
                                            crud_code(F.col("_change_type")).alias("WA_CRUD"))


@register("snapshot_diff")
def _diff(w):
    from tessera.operators.changes import as_of, snapshot_diff
    old = as_of(w.header_feed, ["order_id"], version=0).select(*_STG)
    new = as_of(w.header_feed, ["order_id"], version=2).select(*_STG)
    return snapshot_diff(old, new, ["order_id"], 3, F.lit("2002-01-01 00:00:00").cast("timestamp_ntz"))


@register("row_hash")
def _row_hash(w):
    return w.header_tagged.select("order_id", "_commit_timestamp", "WA_CRUD", "WA_HASH")


@register("hash_reconcile")
def _reconcile(w):
    """Latest staged row per key against the current history row, by row hash."""
    from tessera.operators.changes import as_of, reconcile
    src = quality.tag(as_of(w.header_feed, ["order_id"]), HEADER).select("order_id", "WA_HASH")
    tgt = w.dwh_header.where("WA_ISCURR = 1").select("order_id", "WA_HASH")
    return reconcile(src, tgt, ["order_id"])


@register("digest_diff")
def _digest_diff(w):
    """As ``snapshot_diff``, of stored snapshots: digests first, rows only where they differ."""
    from tessera.operators.changes import as_of
    from tessera.operators.digests import diff_by_digest
    old = cut_lineage(as_of(w.header_feed, ["order_id"], version=0).select(*_STG), "old_snapshot")
    new = cut_lineage(as_of(w.header_feed, ["order_id"], version=2).select(*_STG), "new_snapshot")
    return diff_by_digest(old, new, ["order_id"], 3, F.lit("2002-01-01 00:00:00").cast("timestamp_ntz"))


@register("digest_reconcile")
def _digest_reconcile(w):
    """Keys whose row hash is not the same in the latest staged rows and the current history, and the count of all
    that match."""
    from tessera.functions.hashing import packed_hash
    from tessera.operators.changes import as_of
    from tessera.operators.digests import reconcile_by_digest
    packed = packed_hash("WA_HASH").alias("WA_HASH")            # compared, not shown: half of the text
    src = cut_lineage(quality.tag(as_of(w.header_feed, ["order_id"]), HEADER).select("order_id", packed), "source_hashes")
    tgt = cut_lineage(w.dwh_header.where("WA_ISCURR = 1").select("order_id", packed), "target_hashes")
    return reconcile_by_digest(src, tgt, ["order_id"])


@register("fk_hash")
def _fk_hash(w):
    """Reference-key hash on lines, joined to the header by hash."""
    from tessera.functions.hashing import key_hash
    d = w.dwh_detail.where("WA_ISCURR = 1").select(
        "order_detail_id", F.col("order_id").alias("WK_REF_BUS_ORDER_HEADER"),
        key_hash([F.col("order_id")]).alias("WK_REF_HASH_ORDER_HEADER"))
    h = w.dwh_header.where("WA_ISCURR = 1").select(key_hash([F.col("order_id")]).alias("_h"), "order_currency")
    return d.join(h, d.WK_REF_HASH_ORDER_HEADER == h._h, "left").drop("_h")


@register("canonical_union")
def _canonical(w):
    """Customer activity from two sources in one entity, with provenance."""
    from tessera.sources.tables import load
    o = load(w.spark, w.sf_dir, "orders").select(
        F.col("o_custkey").alias("party_id"), F.col("o_orderdate").alias("activity_ts"),
        F.col("o_totalprice").cast("decimal(18,4)").alias("amount"), F.col("o_orderstatus").alias("status"))
    e = load(w.spark, w.sf_dir, "events").select(
        F.col("user_id").alias("party_id"), F.col("ts").alias("activity_ts"),
        F.col("value").cast("decimal(18,4)").alias("amount"), F.col("event_type").alias("kind"))
    return o.withColumn("source", F.lit("orders")).unionByName(
        e.withColumn("source", F.lit("events")), allowMissingColumns=True)


# ----------------------------------------------------------- audit and lineage
def _audit(w):
    from tessera.sources.fixtures import audit_log
    log = audit_log(w.spark, w.sf_dir)
    now = F.lit(log.agg(F.max("event_time")).scalar())
    return log, now


@register("audit_recent")
def _audit_recent(w):
    from tessera.operators.audit import audit_recent
    log, now = _audit(w)
    return audit_recent(log, now, 7, "DEMO", 100)


@register("audit_object")
def _audit_object(w):
    from tessera.operators.audit import audit_object
    log, now = _audit(w)
    found = audit_object(log, now, 7, "DEMO", "config", "pipeline_sources", 50)
    return found.withColumn("raw_request_params", F.to_json("raw_request_params"))


@register("audit_pipeline_events")
def _audit_pipe(w):
    from tessera.operators.audit import audit_pipeline_events
    log, now = _audit(w)
    return audit_pipeline_events(log, now, 7, 100)


@register("audit_summary")
def _audit_summary(w):
    from tessera.operators.audit import audit_summary
    log, now = _audit(w)
    return audit_summary(log, now, 7, "DEMO", 50)


LINEAGE_TARGETS = ["demo.integration.t1", "demo.integration.t5", "demo.integration.t50", "demo.integration.t500"]


def _edges(w):
    from tessera.sources.fixtures import lineage_edges
    return lineage_edges(w.spark, w.sf_dir)


@register("lineage_direct")
def _lin_direct(w):
    from tessera.operators.lineage import lineage_direct
    return lineage_direct(_edges(w), LINEAGE_TARGETS, 20)


@register("lineage_downstream")
def _lin_down(w):
    from tessera.operators.lineage import lineage_walk
    return lineage_walk(_edges(w), "demo.integration.t1", "downstream", 5)


@register("lineage_upstream")
def _lin_up(w):
    from tessera.operators.lineage import lineage_walk
    return lineage_walk(_edges(w), "demo.integration.t1500", "upstream", 5)


@register("lineage_impact")
def _lin_impact(w):
    from tessera.operators.lineage import lineage_impact
    return lineage_impact(_edges(w), "demo.integration.t2")


# ----------------------------------------------------------- streaming
def _stream_paths(spark, name):
    import uuid
    from tessera.session import scratch_path
    root = scratch_path(spark, "streams", f"{name}_{uuid.uuid4().hex}")
    return root, f"{root}/_checkpoint"


@register("quarantine_stream")
def _q_stream(w):
    from tessera.streaming.feeds import read_feed_stream, write_feed
    from tessera.streaming.pipelines import run_quarantine_stream
    root, ck = _stream_paths(w.spark, "quarantine")
    feed = w.header_feed
    write_feed(feed, f"{root}/feed")
    stream = read_feed_stream(w.spark, f"{root}/feed", feed.schema)
    run_quarantine_stream(stream, HEADER, f"{root}/dwq", ck)
    return w.spark.read.parquet(f"{root}/dwq")


def _history_stream(w, name, entity, scd_type, split_by, make_delta=None):
    from tessera.streaming.feeds import read_feed_stream, write_feed
    from tessera.streaming.pipelines import run_history_stream
    root, ck = _stream_paths(w.spark, name)
    on_delta = make_delta(root) if make_delta else None
    feed = w.events_feed if entity is EVENTS else w.header_feed
    write_feed(feed, f"{root}/feed", split_by=split_by)
    stream = read_feed_stream(w.spark, f"{root}/feed", feed.schema)
    return run_history_stream(stream, entity, scd_type, f"{root}/store", ck, on_delta=on_delta)


@register("scd1_stream")
def _scd1_stream(w):
    return _history_stream(w, "scd1", EVENTS, 1, "_commit_timestamp").history


@register("scd2_stream")
def _scd2_stream(w):
    """Event history kept by a stream whose files arrive out of sequence order;
    surrogates depend on arrival order, so the query leaves them out."""
    return _history_stream(w, "scd2", EVENTS, 2, "event_id").history.drop(EVENTS.wk)


@register("dwh_stream")
def _dwh_stream(w):
    """History view over streamed history whose files arrive out of order: each version with the
    start of its predecessor and of its key's first version (surrogates depend on arrival)."""
    dw = cut_lineage(_history_stream(w, "dwh", EVENTS, 2, "event_id").history, "streamed")
    v = history.history_view(dw, EVENTS)
    starts = v.select(F.col(EVENTS.wk).alias("_k"), F.col("WA_FROMDATE").alias("_s"))
    before = starts.select(F.col("_k").alias(EVENTS.wkp), F.col("_s").alias("previous_from"))
    root = starts.select(F.col("_k").alias(EVENTS.wkr), F.col("_s").alias("root_from"))
    return v.join(before, EVENTS.wkp, "left").join(root, EVENTS.wkr, "left") \
        .select("user_id", "event_id", "WA_FROMDATE", "WA_UNTODATE", "WA_ISCURR", "previous_from", "root_from")


@register("incremental_totals")
def _incremental_totals(w):
    """Monthly revenue by currency and daily revenue by truck, maintained from each batch's signed change of the
    current order versions."""
    from tessera.streaming.totals import Totals
    day = F.to_date("order_ts")
    revenue = {"revenue": F.col("order_total")}
    kept = {}

    def keep(root):
        kept["month"] = Totals(w.spark, f"{root}/monthly", {"period": F.trunc(day, "month"), "member": F.col("order_currency")}, revenue)
        kept["day"] = Totals(w.spark, f"{root}/daily", {"period": day, "member": F.col("truck_id").cast("string")}, revenue)
        return lambda delta, batch: [t.apply(delta, batch) for t in kept.values()]

    _history_stream(w, "totals", HEADER, 2, "_commit_timestamp", keep)
    parts = [t.read().select(F.lit(grain).alias("grain"), "period", "member", F.col("revenue").cast("decimal(38,4)").alias("revenue"),
                             F.col("row_count").alias("orders")) for grain, t in kept.items()]
    return parts[0].unionByName(parts[1])


@register("stream_split")
def _stream_split(w):
    """One stream into history and quarantine: rows read, stored as versions or deletes, and quarantined."""
    out = _history_stream(w, "split", HEADER, 2, "_commit_timestamp")
    kept = out.history.select("order_id", F.col("WA_CRUDDTS").alias("at"), F.lit("history").alias("route"))
    bad = out.quarantine.select("order_id", F.col("WA_CRUDDTS").alias("at"), F.lit("quarantine").alias("route"))
    return kept.unionByName(bad).groupBy("order_id", "route").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))


@register("stream_static_asof")
def _stream_static(w):
    from tessera.streaming.feeds import read_feed_stream, write_feed
    from tessera.streaming.pipelines import run_stream_static_asof
    root, ck = _stream_paths(w.spark, "asof")
    feed = w.detail_feed
    write_feed(feed, f"{root}/feed")
    stream = read_feed_stream(w.spark, f"{root}/feed", feed.schema)
    run_stream_static_asof(stream, DETAIL, w.dwh_header, ["order_id"], "order_ts", f"{root}/out", ck,
                          columns=["WK_ORDER_HEADER", "order_currency", "truck_id"])
    return w.spark.read.parquet(f"{root}/out").drop("batch")
