"""Star schema: SCD1/SCD2 dimensions, the generated calendar, conformed keys and facts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.timeofday import hms_to_seconds
from tessera.operators.history import OPEN_END, open_end
from tessera.operators.keyed import _join_keys, is_broadcast, latest_per_key, sized_broadcast
from tessera.operators.narrow import narrow_columns, packed_columns
from tessera.operators.temporal import as_of_join
from tessera.session import cut_lineage

CONFORMED, AS_WRITTEN = "conformed", "as_written"
_RANKS = "40000000000000000000"              # above twice the root keys, NULL included


def date_key(ts: str | Column) -> Column:
    """``MK_DATE``: the date as a yyyymmdd integer."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyyMMdd").cast("int")


def conformed_keys(dwh: DataFrame, attr: str, wkr: str, mk: str) -> DataFrame:
    """One surrogate per attribute value (NULL included): the smallest root key of
    any version that carried it.  A partial aggregate; one row per value."""
    return dwh.groupBy(attr).agg(F.min(wkr).alias(mk))


def _since_1970(dwh: DataFrame, ts: str) -> Column:
    """Microseconds since 1970, in the order of the times (a time without zone is not read in the session's)."""
    c = F.col(ts)
    if dwh.schema[ts].dataType.typeName() != "timestamp_ntz":
        return F.unix_micros(c.cast("timestamp"))
    clock = F.hour(c) * F.lit(3_600_000_000) + F.minute(c) * F.lit(60_000_000) + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return F.date_diff(c.cast("date"), F.lit("1970-01-01").cast("date")) * F.lit(86_400_000_000) + clock


def _version_rank(dwh: DataFrame, wkr: str) -> Column:
    """(WA_FROMDATE, root key, whether it has ended) as one number in the same order, NULLs lowest: its maximum is a
    fixed-width aggregate, which hashes, where a rank would sort every row of a map task."""
    def from_zero(c: Column) -> Column:                     # NULL: 0, else 1 .. 2^64
        return F.coalesce(c.cast("decimal(20,0)") + F.lit(str((1 << 63) + 1)).cast("decimal(20,0)"), F.lit(0)).cast("decimal(20,0)")

    # times of the years 1 to 9999 are below 2^59, so the number has at most 38 digits
    ended = F.when(F.col("WA_UNTODATE") != open_end(), 1).otherwise(0)
    time = F.coalesce(_since_1970(dwh, "WA_FROMDATE"), F.lit(-(1 << 60))).cast("decimal(19,0)")
    return (time * F.lit(_RANKS).cast("decimal(20,0)") + from_zero(F.col(wkr)) * 2 + ended).cast("decimal(38,0)")


def _ranked(rank: Column, kind) -> tuple[Column, Column]:
    """Root key and end flag out of a :func:`_version_rank`."""
    low = F.pmod(rank, F.lit(_RANKS).cast("decimal(20,0)")).cast("decimal(20,0)")
    ended = F.pmod(low, F.lit(2)).cast("int")
    zero = ((low - ended) / 2).cast("decimal(20,0)")
    return F.when(zero > 0, (zero - F.lit(str((1 << 63) + 1)).cast("decimal(20,0)")).cast(kind)), ended


def _grouped_versions(dwh: DataFrame, rows: DataFrame, by: Sequence[str], wkr: str, deletes_count: bool) -> DataFrame:
    """One row per value of ``by`` in ``rows`` (versions of ``dwh`` with ``_rank``): the latest version's rank, root key and
    deleted flag, the create/change dates and the smallest root key over all its versions, by one hash aggregate."""
    change = F.when(F.col("WA_CRUD") != "C", F.col("WA_CRUDDTS"))
    if deletes_count:
        change = F.greatest(change, F.when(F.col("WA_UNTODATE") != open_end(), F.col("WA_UNTODATE")))
    latest, ended = _ranked(F.col("_rank"), dwh.schema[wkr].dataType)
    return rows.groupBy(*by).agg(
        F.min("WA_CRUDDTS").alias("MA_CREATEDATE"), F.max(change).alias("MA_CHANGEDATE"),
        F.min(wkr).alias("_conformed"), F.max("_rank").alias("_rank")) \
        .withColumns({"_latest": latest, "MA_ISDEL": ended})


def _with_carried(dwh: DataFrame, values: DataFrame, by: Sequence[str], wkr: str, carried: Sequence[str]) -> DataFrame:
    """:func:`_grouped_versions` with columns of the latest version, which is looked up by its rank; the values are
    broadcast when their counted size allows."""
    few, _ = sized_broadcast(values)
    versions = dwh.select(*(F.col(c).alias(f"_c_{c}") for c in carried), _version_rank(dwh, wkr).alias("_rank"))
    # a history has one version per root key and start; of several with the same, any is the latest
    return latest_per_key(versions.join(few, "_rank"), by, ["_rank"])


def dim_scd1(dwh: DataFrame, attr: str, wkr: str, mk: str, carried: Sequence[str] = (),
             key_mode: str = CONFORMED, deletes_count: bool = False) -> DataFrame:
    """SCD1 dimension over a history: one row per attribute value (NULL is the
    unknown bucket) from its latest version by ``WA_FROMDATE`` (root key as
    tie-break), with create/change dates over all its versions and a deleted flag.

    Dates, keys, the flag and the latest version's rank are one grouped aggregate with one row
    per value and map task; carried columns alone are looked up by that rank.
    """
    rows = dwh.select(F.col(attr).alias("_v"), wkr, "WA_UNTODATE", "WA_CRUD", "WA_CRUDDTS", _version_rank(dwh, wkr).alias("_rank"))
    j = _grouped_versions(dwh, rows, ["_v"], wkr, deletes_count)
    if carried:
        j = _with_carried(dwh, j, ["_v"], wkr, carried)
    key = F.col("_latest") if key_mode == AS_WRITTEN else F.col("_conformed")
    return j.select(key.alias(mk), F.col("_v").alias(attr), *(F.col(f"_c_{c}").alias(c) for c in carried),
                    "MA_CREATEDATE", "MA_CHANGEDATE", "MA_ISDEL")


def dims_scd1_stacked(dwh: DataFrame, specs: Sequence[tuple[str, Sequence[str]]], wkr: str,
                      deletes_count: bool = False) -> DataFrame:
    """Several SCD1 dimensions of one history in one pass, stacked.

    ``specs`` lists (attribute, carried columns).  Every version row is exploded
    map-side into one (dimension number ``_d``, value as text ``_v``) row per
    dimension; a hash aggregate (partial) collapses them per value before the
    shuffle, so the stacking costs one scan and little shuffle volume, and no
    task sorts the rows that it explodes.  Only values of dimensions with carried
    columns are looked up again.  Both key modes are kept
    (``_mk_conformed``, ``_mk_as_written``); :func:`dim_from_stacked` takes one
    dimension back out with its value in the original type.
    """
    carried_all = list(dict.fromkeys(c for _, cs in specs for c in cs))
    elems = [F.struct(F.lit(i).alias("_d"), F.col(attr).cast("string").alias("_v")) for i, (attr, _) in enumerate(specs)]
    meta = [wkr, "WA_UNTODATE", "WA_CRUD", "WA_CRUDDTS", "_rank"]
    base = dwh.withColumn("_rank", _version_rank(dwh, wkr)).select(*meta, F.explode(F.array(*elems)).alias("_e")).select(*meta, "_e.*")
    j = _grouped_versions(dwh, base, ["_d", "_v"], wkr, deletes_count)
    if carried_all:
        values, carries = cut_lineage(j, "dim_values"), F.col("_d").isin([i for i, (_, cs) in enumerate(specs) if cs])
        j = _with_carried(dwh, values.where(carries), ["_d", "_v"], wkr, carried_all) \
            .unionByName(values.where(~carries), allowMissingColumns=True)
    has = {c: [i for i, (_, cs) in enumerate(specs) if c in cs] for c in carried_all}
    return j.select(
        "_d", "_v", F.col("_latest").alias("_mk_as_written"), F.col("_conformed").alias("_mk_conformed"),
        *(F.when(F.col("_d").isin(has[c]), F.col(f"_c_{c}")).alias(c) for c in carried_all),
        "MA_CREATEDATE", "MA_CHANGEDATE", "MA_ISDEL",
    )


def dim_from_stacked(stacked: DataFrame, attr: str, attr_type, mk: str, carried: Sequence[str] = (),
                     key_mode: str = CONFORMED) -> DataFrame:
    """One dimension out of :func:`dims_scd1_stacked` (rows of that dimension only),
    in the column layout of :func:`dim_scd1`."""
    key = "_mk_as_written" if key_mode == AS_WRITTEN else "_mk_conformed"
    return stacked.select(F.col(key).alias(mk), F.col("_v").cast(attr_type).alias(attr), *carried,
                          "MA_CREATEDATE", "MA_CHANGEDATE", "MA_ISDEL")


def with_shift_duration(d: DataFrame) -> DataFrame:
    """Shift length in minutes from the HH:mm:ss start and end."""
    minutes = F.floor((hms_to_seconds("shift_end_time") - hms_to_seconds("shift_start_time")) / 60).cast("int")
    return d.withColumn("shift_duration_minutes", minutes)


def dim_shift(dwh_header: DataFrame, key_mode: str = CONFORMED) -> DataFrame:
    """Shift dimension with the latest row's start/end time and its length in minutes."""
    return with_shift_duration(dim_scd1(dwh_header, "shift_id", "WKR_ORDER_HEADER", "MK_SHIFT",
                                        ["shift_start_time", "shift_end_time"], key_mode))


def dim_scd2(dwh: DataFrame, e_keys: Sequence[str], wk: str, wkr: str, mk: str, attrs: Sequence[str]) -> DataFrame:
    """SCD2 dimension: every version, keyed by its own surrogate, with validity."""
    return dwh.select(F.col(wk).alias(mk), F.col(wkr).alias(f"{mk}_ROOT"), *e_keys, *attrs,
                      "WA_FROMDATE", "WA_UNTODATE", "WA_ISCURR")


def dim_date(dwh_header: DataFrame, ts: str = "order_ts") -> DataFrame:
    """Gap-free calendar over the current rows' event dates (``explode(sequence)``)."""
    bounds = dwh_header.where(F.col("WA_ISCURR") == 1) \
        .agg(F.min(F.col(ts).cast("date")).alias("lo"), F.max(F.col(ts).cast("date")).alias("hi"))
    cal = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    return cal.select(
        date_key(d).alias("MK_DATE"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).alias("day_of_week"), F.weekofyear(d).alias("week_of_year"),
        F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0).alias("is_weekend"),
        F.date_trunc("month", d).cast("date").alias("year_month_start"),
        F.date_trunc("quarter", d).cast("date").alias("year_quarter_start"),
        F.date_trunc("year", d).cast("date").alias("year_start"),
    )


# Header-derived dimension keys of a fact: key column -> attribute.
HEADER_DIMS = (
    ("MK_TRUCK", "truck_id"), ("MK_LOCATION", "location_id"), ("MK_CUSTOMER", "customer_id"),
    ("MK_SHIFT", "shift_id"), ("MK_CURRENCY", "order_currency"), ("MK_ORDER_CHANNEL", "order_channel"),
    ("MK_DISCOUNT", "discount_id"),
)


Store = Callable[[DataFrame, str], DataFrame]


def lookup_conformed(fact: DataFrame, dwh: DataFrame, wkr: str, dims: Sequence[tuple[str, str]],
                     tables=None, before: Store | None = None, after: Store | None = None) -> DataFrame:
    """Attach each attribute's conformed surrogate via null-safe lookups.
    Each lookup table has one row per attribute value; it is broadcast when its
    counted size allows, otherwise joined by shuffle.  ``tables(attr, mk)`` may
    supply prebuilt lookup tables.

    Rows are shuffled narrow (:mod:`~tessera.operators.narrow`).  Where a lookup shuffles, ``before`` stores the rows that it
    shuffles, so the shuffles that made them need not stay on disk beside it, and ``after`` its result, for callers that
    read it more than once."""
    found = {attr: tables(attr, mk) if tables else sized_broadcast(conformed_keys(dwh, attr, wkr, mk))[0] for mk, attr in dims}
    large = {attr: keys for attr, keys in found.items() if not is_broadcast(keys)}
    out = fact
    if large:
        def get(c: str) -> Column:
            return F.col(f"`{c}`")
        taken = [mk for mk, attr in dims if attr in large]
        columns, whole = narrow_columns(fact, skip=list(large))
        rows = fact.select(*columns.values())
        rows = before(rows, "lookup_rows") if before else rows
        packed, unpacked = packed_columns(rows, skip=list(large))
        out = rows.select(*packed.values())
        for attr, keys in large.items():
            out = _join_keys(out, keys, [attr], "left")
        out = out.select(*unpacked(get), *taken).select(*whole(get), *taken)
    for attr, keys in found.items():
        if attr not in large:
            out = _join_keys(out, keys, [attr], "left")
    return after(out, "looked_up") if after and large else out


def fct_order(dwh_header: DataFrame, key_mode: str = CONFORMED, lookup=None) -> DataFrame:
    """Order-grain fact from the current header versions, with their load time for refreshes."""
    cur = dwh_header.where(F.col("WA_ISCURR") == 1)
    base = cur.select(
        date_key("order_ts").alias("MK_DATE"), "WKR_ORDER_HEADER",
        *[a for _, a in HEADER_DIMS], "order_id", "order_amount", "order_tax_amount",
        "order_discount_amount", "order_total",
        F.timestamp_diff("SECOND", F.col("order_ts"), F.col("served_ts")).alias("time_to_serve_seconds"),
        "order_ts", "served_ts", "WA_CRUDDTS",
    )
    if key_mode == AS_WRITTEN:
        keyed = base.withColumns({mk: F.col("WKR_ORDER_HEADER") for mk, _ in HEADER_DIMS})
    else:
        keyed = lookup_conformed(base, dwh_header, "WKR_ORDER_HEADER", HEADER_DIMS,
                                 (lambda a, m: lookup("header", a, m)) if lookup else None)
    return keyed.select("MK_DATE", *[mk for mk, _ in HEADER_DIMS], "order_id", "order_amount", "order_tax_amount",
                        "order_discount_amount", "order_total", "time_to_serve_seconds", "order_ts", "served_ts",
                        "WA_CRUDDTS")


def sales_line(dwh_detail: DataFrame, dwh_header: DataFrame, at: str = "order_ts", how: str = "inner",
               columns: Sequence[str] | None = None) -> DataFrame:
    """Line-grain view: current lines with the header version valid at the line's
    event time, header attributes denormalised onto each line.  ``columns`` names those that are
    wanted (all by default): only what they need is shuffled."""
    line = ("WK_ORDER_DETAIL", "WKR_ORDER_DETAIL", "order_detail_id", "order_id", "menu_item_id", "quantity", "unit_price", "price",
            "order_item_discount_amount", "line_number", "WA_CRUDDTS", "WA_CRUD", "WA_SRC", "WA_RUNID")
    header = ("WK_ORDER_HEADER", "WKR_ORDER_HEADER", "truck_id", "location_id", "customer_id", "shift_id", "discount_id",
              "shift_start_time", "shift_end_time", "order_channel", "order_ts", "served_ts", "order_currency", "order_amount",
              "order_tax_amount", "order_discount_amount", "order_total")
    header += tuple(mk for mk, _ in HEADER_DIMS if mk in dwh_header.columns)
    source = {**{c: f"d.{c}" for c in line}, **{c: f"h.{c}" for c in header}, "line_ts": f"d.{at}"}
    wanted = list(columns or [
        "WK_ORDER_DETAIL", "WKR_ORDER_DETAIL", "WK_ORDER_HEADER", "WKR_ORDER_HEADER", *line[2:10], *header[2:], "line_ts", *line[10:]])
    d = dwh_detail.where(F.col("WA_ISCURR") == 1).select(*dict.fromkeys(["order_id", *(c for c in line if c in wanted), at]))
    h = dwh_header.select("order_id", *(c for c in header if c in wanted), "WA_FROMDATE", "WA_UNTODATE")
    j = as_of_join(d, h, ["order_id"], at, how, names=("d", "h"))
    return j.select(*(F.col(source[c]).alias(c) for c in wanted))


def fct_sales_line(dwh_detail: DataFrame, dwh_header: DataFrame, key_mode: str = CONFORMED,
                   how: str = "inner", lookup=None, store: Store = cut_lineage) -> DataFrame:
    """Line-grain fact: the as-of join of lines to header versions plus a subtotal.

    Where dimensions are too large to be broadcast, ``store`` keeps the versions with their keys (the as-of join reads
    them twice) and the joined lines (the join's shuffle then need not stay beside that of the item lookup)."""
    # an inner join takes keys that its versions have; a line without a version has the keys of the unknown values
    early = key_mode != AS_WRITTEN and how == "inner"
    found = (lambda a, m: lookup("header", a, m)) if lookup else None
    header = dwh_header
    if early:
        header = lookup_conformed(dwh_header.select("order_id", "WA_FROMDATE", "WA_UNTODATE", *[a for _, a in HEADER_DIMS], "order_ts", "served_ts"),
                                  dwh_header, "WKR_ORDER_HEADER", HEADER_DIMS, found, after=store)
    taken = [mk for mk, _ in HEADER_DIMS] if early else ["WKR_ORDER_HEADER", *[a for _, a in HEADER_DIMS]]
    sl = sales_line(dwh_detail, header, how=how, columns=[
        *taken, "WKR_ORDER_DETAIL", "menu_item_id", "order_id", "order_detail_id",
        "line_number", "quantity", "unit_price", "price", "order_item_discount_amount", "order_ts", "served_ts"])
    if key_mode == AS_WRITTEN:
        keyed = sl.withColumns({mk: F.col("WKR_ORDER_HEADER") for mk, _ in HEADER_DIMS}) \
            .withColumn("MK_MENU_ITEM", F.col("WKR_ORDER_DETAIL"))
    else:
        sl = sl.drop("WKR_ORDER_DETAIL", "WKR_ORDER_HEADER")
        keyed = sl if early else lookup_conformed(sl, dwh_header, "WKR_ORDER_HEADER", HEADER_DIMS, found, store)
        keyed = lookup_conformed(keyed, dwh_detail, "WKR_ORDER_DETAIL", [("MK_MENU_ITEM", "menu_item_id")],
                                 (lambda a, m: lookup("detail", a, m)) if lookup else None, store)
    return keyed.withColumns({
        "MK_DATE": date_key("order_ts"),
        "line_subtotal": (F.col("quantity") * F.col("unit_price")).cast("decimal(38,4)"),
    }).select("MK_DATE", *[mk for mk, _ in HEADER_DIMS], "MK_MENU_ITEM", "order_id", "order_detail_id",
                        "line_number", "quantity", "unit_price", "price", "order_item_discount_amount",
                        "line_subtotal", "order_ts", "served_ts")


def fact_increment(new: DataFrame, old: DataFrame, strategy: str, watermark: str | None = None,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Next fact table under a load strategy.

    ``append``: old rows plus the new rows at or past the old watermark whose key is not there
    yet (all new rows while there is no watermark), so a rerun adds nothing and a row that
    ties with the mark is not lost; ``merge``: new rows replace old rows of the same key
    (upsert); ``overwrite``: the new rows.
    """
    if strategy == "overwrite":
        return new
    if strategy == "append":
        mark = old.agg(F.max(watermark)).scalar()       # scalar subquery, one value
        fresh = new.where(mark.isNull() | F.coalesce(F.col(watermark) >= mark, F.lit(True)))
        return old.unionByName(fresh.join(old.select(*keys), list(keys), "left_anti"))
    if strategy == "merge":
        kept = old.join(new.select(*keys), list(keys), "left_anti")
        return kept.unionByName(new)
    raise ValueError(f"unknown load strategy {strategy!r}")


__all__ = ["OPEN_END", "date_key", "dim_scd1", "dims_scd1_stacked", "dim_from_stacked", "dim_shift", "dim_scd2", "dim_date", "fct_order",
           "fct_sales_line", "sales_line", "fact_increment", "conformed_keys", "lookup_conformed"]
