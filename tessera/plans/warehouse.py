"""The assembled warehouse over one data folder: staged feeds, tagged sources,
history tables, history views, dimensions and facts.

Tagged sources and history tables are written once per session and folder and
shared by both key modes; history views are projections of the stored history;
dimensions and facts are written once per key mode.  Queries above them stay
lazy, so Catalyst sees each one whole.  Independent tables are built as
concurrent Spark jobs (``build_history``, ``build_marts``).
"""

from __future__ import annotations

import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import history, quality, star
from tessera.operators.keyed import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, sized_broadcast
from tessera.plans.entities import DETAIL, EVENTS, HEADER
from tessera.session import CODEC, cut_lineage, drop_table, folder_stamp, release_tables, scratch_path, stored_bytes
from tessera.sources import fixtures

# Header dimensions built in one pass: attribute, surrogate column, carried columns.
HEADER_DIM_SPECS = (
    ("truck_id", "MK_TRUCK", ()), ("location_id", "MK_LOCATION", ()), ("customer_id", "MK_CUSTOMER", ()),
    ("order_currency", "MK_CURRENCY", ()), ("order_channel", "MK_ORDER_CHANNEL", ()),
    ("discount_id", "MK_DISCOUNT", ()), ("shift_id", "MK_SHIFT", ("shift_start_time", "shift_end_time")),
)

# by session, folder, (key mode,) and the state of the folder's files: a changed folder gets a new warehouse
_CACHE: dict[tuple[str, str, str, str], "Warehouse"] = {}
_SHARED: dict[tuple[str, str, str], tuple[dict, dict]] = {}
_SHARED_GUARD = threading.Lock()


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, key_mode: str = star.CONFORMED, stamp: str = ""):
        self.spark, self.sf_dir, self.key_mode, self.stamp = spark, sf_dir, key_mode, stamp
        self._small: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()

    def _lock(self, name: str) -> threading.Lock:
        with self._guard:
            return self._locks.setdefault(name, threading.Lock())

    def _bounded(self, name: str, build) -> DataFrame:
        """A dimension-sized table: materialised once, broadcast when its counted
        size allows (else joined by shuffle).  Safe to call from several threads."""
        with self._lock(name):
            if name not in self._small:
                self._small[name], _ = sized_broadcast(build())
        return self._small[name]

    def _once(self, name: str, build) -> DataFrame:
        """A large table materialised once per warehouse (thread-safe)."""
        with self._lock(name):
            if name not in self._small:
                self._small[name] = build()
        return self._small[name]

    def _shared(self, name: str, build) -> DataFrame:
        """A table that does not depend on the key mode (tagged sources, history):
        built once per session and folder, shared by both key modes."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.stamp)
        with _SHARED_GUARD:
            tables, locks = _SHARED.setdefault(key, ({}, {}))
            lock = locks.setdefault(name, threading.Lock())
        with lock:                      # one lock per table: independent tables build concurrently
            if name not in tables:
                tables[name] = build()
        return tables[name]

    def build_history(self, threads: int = 3) -> "Warehouse":
        """Materialise the three history tables as concurrent Spark jobs: they are
        independent, and each job alone leaves cores idle between its stages."""
        self._concurrently([lambda: self._dw_header, lambda: self._dw_detail, lambda: self._dw_events], threads)
        return self

    def build_marts(self, threads: int = 4) -> "Warehouse":
        """Materialise dimensions, calendar and facts, independent ones concurrently."""
        self._concurrently([lambda: self._header_dims, lambda: self.dim_menu_item, lambda: self.dim_date], threads)
        self._concurrently([lambda: self.fct_order, lambda: self.fct_sales_line], threads)
        return self

    @staticmethod
    def _concurrently(jobs, threads: int) -> None:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for f in [pool.submit(j) for j in jobs]:
                f.result()

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, key_mode: str = star.CONFORMED) -> "Warehouse":
        k = (spark.sparkContext.applicationId, sf_dir, key_mode, folder_stamp(spark, sf_dir))
        with _SHARED_GUARD:
            if k not in _CACHE:
                _CACHE[k] = cls(spark, sf_dir, key_mode, k[3])
            return _CACHE[k]

    def close(self) -> None:
        """Forget this folder's warehouses and remove the intermediate tables that this session wrote.
        Frames returned before can't be read afterwards."""
        app = self.spark.sparkContext.applicationId
        with _SHARED_GUARD:
            for cache in (_CACHE, _SHARED):
                for k in [k for k in cache if k[:2] == (app, self.sf_dir)]:
                    del cache[k]
        release_tables(self.spark)

    # staged change feeds -------------------------------------------------
    @property
    def header_feed(self) -> DataFrame:
        return fixtures.chg_order_header(self.spark, self.sf_dir)

    @property
    def detail_feed(self) -> DataFrame:
        return fixtures.chg_order_detail(self.spark, self.sf_dir)

    @property
    def events_feed(self) -> DataFrame:
        return fixtures.chg_events(self.spark, self.sf_dir)

    # tagged sources: stored once, like the tagged-source materialised views, and the rules counted on
    # that write; history, quarantine and rule counts all read the stored rows
    def _tagged(self, name: str, feed: DataFrame, e) -> tuple[DataFrame, DataFrame]:
        return self._shared(f"{name}_tagged", lambda: quality.store_tagged(quality.tag(feed, e), e, f"{name}_src"))

    @property
    def run_counts(self) -> DataFrame:
        """Violations by entity and rule, as seen by the writes of the tagged sources."""
        header, detail, events = (self._tagged(*a)[1] for a in (
            ("header", self.header_feed, HEADER), ("detail", self.detail_feed, DETAIL), ("events", self.events_feed, EVENTS)))
        return header.unionByName(detail).unionByName(events)

    @property
    def header_tagged(self) -> DataFrame:
        return self._tagged("header", self.header_feed, HEADER)[0]

    @property
    def detail_tagged(self) -> DataFrame:
        return self._tagged("detail", self.detail_feed, DETAIL)[0]

    @property
    def events_tagged(self) -> DataFrame:
        return self._tagged("events", self.events_feed, EVENTS)[0]

    # history tables (materialised by the surrogate numbering, root key included)
    @property
    def _dw_header(self) -> DataFrame:
        return self._shared("_dw_header", lambda: history.scd2(quality.clean(self.header_tagged), HEADER, with_root=True, hashed=True))

    @property
    def _dw_detail(self) -> DataFrame:
        return self._shared("_dw_detail", lambda: history.scd2(quality.clean(self.detail_tagged), DETAIL, with_root=True, hashed=True))

    @property
    def _dw_events(self) -> DataFrame:
        return self._shared("_dw_events", lambda: history.scd2(quality.clean(self.events_tagged), EVENTS, with_root=True, hashed=True))

    @property
    def dw_header(self) -> DataFrame:
        return self._dw_header.drop(HEADER.wkr)

    @property
    def dw_detail(self) -> DataFrame:
        return self._dw_detail.drop(DETAIL.wkr)

    @property
    def dw_events(self) -> DataFrame:
        return self._dw_events.drop(EVENTS.wkr)

    # history views: projections of the stored history (no shuffle, nothing rewritten)
    @property
    def dwh_header(self) -> DataFrame:
        return history.history_view(self._dw_header, HEADER)

    @property
    def dwh_detail(self) -> DataFrame:
        return history.history_view(self._dw_detail, DETAIL)

    @property
    def dwh_events(self) -> DataFrame:
        return history.history_view(self._dw_events, EVENTS)

    # dimensions ------------------------------------------------------------
    @property
    def _header_dims(self) -> tuple[str, dict[int, int]]:
        """All header dimensions in one pass over the history, written once
        partitioned by dimension and shared by both key modes.  Returns the
        folder and the rows per dimension (one small row per dimension)."""
        def build():
            path = scratch_path(self.spark, "tables", f"header_dims-{uuid.uuid4().hex}")
            stacked = star.dims_scd1_stacked(self.dwh_header, [(a, c) for a, _, c in HEADER_DIM_SPECS], HEADER.wkr)
            stacked.write.mode("error").option("compression", CODEC).partitionBy("_d").parquet(path)
            counts = self.spark.read.parquet(path).groupBy("_d").agg(F.count(F.lit(1)).alias("n")).collect()
            return path, {r["_d"]: r["n"] for r in counts}
        return self._shared("header_dims", build)

    def dim(self, attr: str, mk: str, key_mode: str | None = None) -> DataFrame:
        """A header SCD1 dimension out of the one-pass build, broadcast when its own
        row count and stored size are within the bounds."""
        mode = key_mode or self.key_mode
        path, counts = self._header_dims
        i = next(n for n, (a, _, _) in enumerate(HEADER_DIM_SPECS) if a == attr)
        carried = HEADER_DIM_SPECS[i][2]
        if i in counts:
            part = self.spark.read.parquet(f"{path}/_d={i}")
            small = counts[i] <= MAX_BROADCAST_ROWS and stored_bytes(self.spark, f"{path}/_d={i}") <= MAX_BROADCAST_BYTES
        else:
            part, small = self.spark.read.parquet(path).where(F.col("_d") == i).drop("_d"), True
        d = star.dim_from_stacked(part, attr, self.dwh_header.schema[attr].dataType, mk, carried, mode)
        if attr == "shift_id":
            d = star.with_shift_duration(d)
        return F.broadcast(d) if small else d

    @property
    def dim_truck(self) -> DataFrame:
        return self.dim("truck_id", "MK_TRUCK")

    @property
    def dim_location(self) -> DataFrame:
        return self.dim("location_id", "MK_LOCATION")

    @property
    def dim_customer(self) -> DataFrame:
        return self.dim("customer_id", "MK_CUSTOMER")

    @property
    def dim_currency(self) -> DataFrame:
        return self.dim("order_currency", "MK_CURRENCY")

    @property
    def dim_order_channel(self) -> DataFrame:
        return self.dim("order_channel", "MK_ORDER_CHANNEL")

    @property
    def dim_discount(self) -> DataFrame:
        return self.dim("discount_id", "MK_DISCOUNT")

    @property
    def dim_shift(self) -> DataFrame:
        return self.dim("shift_id", "MK_SHIFT")

    @property
    def dim_menu_item(self) -> DataFrame:
        return self._bounded(f"dim_menu_item_id_{self.key_mode}", lambda: star.dim_scd1(
            self.dwh_detail, "menu_item_id", DETAIL.wkr, "MK_MENU_ITEM", key_mode=self.key_mode))

    @property
    def dim_date(self) -> DataFrame:
        return self._bounded("dim_date", lambda: star.dim_date(self.dwh_header))

    # facts (materialised, as the fact tables of the datamart) ---------------
    @property
    def fct_order(self) -> DataFrame:
        return self._once("fct_order", lambda: cut_lineage(
            star.fct_order(self.dwh_header, self.key_mode, lookup=self.conformed), "fct_order"))

    @property
    def fct_sales_line(self) -> DataFrame:
        def build():
            passing: list[DataFrame] = []

            def store(rows: DataFrame, name: str) -> DataFrame:
                passing.append(cut_lineage(rows, name))
                return passing[-1]
            fact = cut_lineage(star.fct_sales_line(self.dwh_detail, self.dwh_header, self.key_mode, lookup=self.conformed, store=store),
                               "fct_sales_line")
            for table in passing:
                drop_table(table)
            return fact
        return self._once("fct_sales_line", build)

    def conformed(self, src: str, attr: str, mk: str) -> DataFrame:
        """Conformed key table of one attribute (one row per value, NULL included).
        The conformed dimension already holds exactly this key, so the lookup is a
        projection of the stored dimension, not another pass over the history."""
        if src == "detail":
            dim = self._bounded(f"dim_{attr}_{star.CONFORMED}", lambda: star.dim_scd1(
                self.dwh_detail, attr, DETAIL.wkr, mk, key_mode=star.CONFORMED))
        else:
            dim = self.dim(attr, mk, star.CONFORMED)
        return dim.select(attr, mk)

    @property
    def sales_line(self) -> DataFrame:
        return star.sales_line(self.dwh_detail, self.dwh_header)
