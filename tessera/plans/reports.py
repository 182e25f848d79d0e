"""Dashboard and analysis queries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import star
from tessera.operators.temporal import as_of_join
from tessera.plans.warehouse import Warehouse


def _avg2(c: str):
    """Average rounded to cents, as a double (the same value in every engine)."""
    return F.round(F.avg(c), 2).cast("double")


def monthly_revenue_by_currency(w: Warehouse) -> DataFrame:
    f, d, c = w.fct_order, w.dim_date, w.dim_currency
    return (f.join(d, "MK_DATE").join(c, "MK_CURRENCY")
            .groupBy(F.col("year_month_start").alias("year_month"), "order_currency")
            .agg(F.sum("order_total").alias("total_revenue"))
            .orderBy("year_month", "order_currency"))


def top_trucks_by_revenue(w: Warehouse) -> DataFrame:
    return (w.fct_order.join(w.dim_truck, "MK_TRUCK").groupBy("truck_id")
            .agg(F.sum("order_total").alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), F.asc_nulls_first("truck_id")).limit(10))


def top_locations_by_revenue(w: Warehouse) -> DataFrame:
    return (w.fct_order.join(w.dim_location, "MK_LOCATION").groupBy("location_id")
            .agg(F.sum("order_total").alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), F.asc_nulls_first("location_id")).limit(10))


def kpi_totals(w: Warehouse) -> DataFrame:
    return w.fct_order.agg(F.sum("order_total").alias("total_revenue"), F.count(F.lit(1)).alias("total_orders"))


def fact_listing(w: Warehouse) -> DataFrame:
    return (w.fct_order.select("MK_DATE", "MK_TRUCK", "MK_LOCATION", "MK_CURRENCY", "MK_ORDER_CHANNEL", "order_id",
                               "order_total")
            .orderBy(F.desc("MK_DATE"), F.desc("order_total"), "order_id").limit(20))


def orders_by_truck_key(w: Warehouse) -> DataFrame:
    return (w.fct_order.groupBy("MK_TRUCK")
            .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("order_total").alias("total_revenue"),
                 _avg2("order_total").alias("avg_order_value"))
            .orderBy(F.desc("total_revenue"), "MK_TRUCK").limit(20))


def orders_by_truck(w: Warehouse) -> DataFrame:
    return (w.fct_order.join(w.dim_truck, "MK_TRUCK").groupBy("truck_id")
            .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("order_total").alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), F.asc_nulls_first("truck_id")).limit(10))


def monthly_trend_by_key(w: Warehouse) -> DataFrame:
    return (w.fct_order.join(w.dim_date, "MK_DATE").groupBy("year_month_start", "MK_CURRENCY")
            .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("order_total").alias("total_revenue"),
                 _avg2("order_total").alias("avg_order_value"))
            .orderBy(F.desc("year_month_start"), F.desc("total_revenue")))


def fact_for_one_truck(w: Warehouse, truck_id: int = 1, from_date: int = 19970101) -> DataFrame:
    """Line fact of one truck from a date on; the truck key is a scalar subquery."""
    mk = w.dim_truck.where(F.col("truck_id") == truck_id).select("MK_TRUCK").scalar()
    f = w.fct_sales_line
    return (f.where((F.col("MK_TRUCK") == mk) & (F.col("MK_DATE") >= from_date))
            .groupBy("MK_DATE", "MK_TRUCK", "MK_CURRENCY")
            .agg(F.count(F.lit(1)).alias("line_count"), F.sum("line_subtotal").alias("subtotal"))
            .orderBy("MK_DATE"))


def sales_by_hour_and_day(w: Warehouse) -> DataFrame:
    return (w.fct_sales_line.join(w.dim_date, "MK_DATE")
            .groupBy(F.hour("order_ts").alias("order_hour"), F.col("day_name").alias("order_day_of_week"),
                     "day_of_week")
            .agg(F.count(F.lit(1)).alias("line_count"), _avg2("line_subtotal").alias("avg_line_value"))
            .orderBy("day_of_week", "order_hour").drop("day_of_week"))


def _last_date(w: Warehouse):
    """The newest order date in the fact: 'now' for relative questions, as a scalar subquery."""
    return w.fct_order.agg(F.max(F.col("order_ts").cast("date"))).scalar()


def best_truck_last_week(w: Warehouse) -> DataFrame:
    last = _last_date(w)
    f = w.fct_order.where(F.col("order_ts").cast("date") > F.date_sub(last, 7))
    return (f.join(w.dim_truck, "MK_TRUCK").groupBy("truck_id")
            .agg(F.sum("order_total").alias("total_revenue"), F.count(F.lit(1)).alias("total_orders"))
            .orderBy(F.desc("total_revenue"), F.asc_nulls_first("truck_id")).limit(1))


def hourly_two_trucks(w: Warehouse, trucks: tuple[int, int] = (1, 2)) -> DataFrame:
    return (w.fct_sales_line.join(w.dim_truck, "MK_TRUCK").where(F.col("truck_id").isin(*trucks))
            .groupBy("truck_id", F.hour("served_ts").alias("order_hour"))
            .agg(F.count(F.lit(1)).alias("line_count"), F.sum("line_subtotal").alias("revenue"))
            .orderBy("truck_id", "order_hour"))


def avg_order_value_by_location(w: Warehouse) -> DataFrame:
    """Average order value per location in the newest month of the fact."""
    month = F.date_trunc("month", F.lit(_last_date(w))).cast("date")
    f = w.fct_order.join(w.dim_date, "MK_DATE").where(F.col("year_month_start") == month)
    return (f.join(w.dim_location, "MK_LOCATION").groupBy("location_id")
            .agg(_avg2("order_total").alias("avg_order_value"), F.count(F.lit(1)).alias("total_orders"))
            .orderBy(F.desc("avg_order_value"), F.asc_nulls_first("location_id")))


def best_item_on_sunday(w: Warehouse) -> DataFrame:
    f = w.fct_sales_line.join(w.dim_date.where(F.col("day_name") == "Sunday"), "MK_DATE")
    return (f.join(w.dim_menu_item, "MK_MENU_ITEM").groupBy("menu_item_id")
            .agg(F.sum("line_subtotal").alias("revenue"), F.sum("quantity").alias("quantity"))
            .orderBy(F.desc("revenue"), "menu_item_id").limit(1))


def daily_sales_by_truck(w: Warehouse) -> DataFrame:
    return (w.fct_order.join(w.dim_truck, "MK_TRUCK")
            .groupBy(F.col("order_ts").cast("date").alias("order_date"), "truck_id")
            .agg(F.sum("order_total").alias("total_revenue"), F.count(F.lit(1)).alias("total_orders")))


def daily_sales_by_location(w: Warehouse) -> DataFrame:
    return (w.fct_order.join(w.dim_location, "MK_LOCATION")
            .groupBy(F.col("order_ts").cast("date").alias("order_date"), "location_id")
            .agg(F.sum("order_total").alias("total_revenue"), F.count(F.lit(1)).alias("total_orders")))


def date_roles(w: Warehouse) -> DataFrame:
    """One calendar in two roles: order date and served date; a fact whose date is off the
    calendar, or unknown, counts under NULL."""
    od = w.dim_date.select(F.col("MK_DATE").alias("od_key"), F.col("year").alias("order_year"))
    sd = w.dim_date.select(F.col("MK_DATE").alias("sd_key"), F.col("day_name").alias("served_day_name"))
    f = w.fct_order.withColumn("MK_SERVED_DATE", star.date_key("served_ts"))
    return (f.join(od, f.MK_DATE == od.od_key, "left").join(sd, f.MK_SERVED_DATE == sd.sd_key, "left")
            .groupBy("order_year", "served_day_name").agg(F.count(F.lit(1)).alias("total_orders")))


def conformed_dim_lookup(w: Warehouse) -> DataFrame:
    """Facts per currency through the conformed key: every fact finds its dimension row."""
    return (w.fct_order.join(w.dim_currency, "MK_CURRENCY").groupBy("MK_CURRENCY", "order_currency")
            .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("order_total").alias("total_revenue")))


def fct_temporal_left(w: Warehouse) -> DataFrame:
    """Current lines with the header version, and the customer's event version, valid at the line
    time; unmatched lines kept. Each dimension costs one shuffle on its key."""
    lines = star.sales_line(w.dwh_detail, w.dwh_header, how="left", columns=[
        "order_detail_id", "order_id", "line_number", "line_ts", "WK_ORDER_HEADER", "order_currency", "customer_id",
        "quantity", "price"])
    events = w.dwh_events.select("user_id", "WK_USER_EVENT", "event_type", "WA_FROMDATE", "WA_UNTODATE")
    both = as_of_join(lines, events, {"customer_id": "user_id"}, "line_ts", "left", names=("d", "e"))
    return both.select("d.order_detail_id", "d.order_id", "d.line_number", "d.line_ts", "d.WK_ORDER_HEADER",
                       "d.order_currency", "e.WK_USER_EVENT", "e.event_type", "d.quantity", "d.price")


def fact_incremental(w: Warehouse, watermark_date: str = "1999-01-01") -> DataFrame:
    """Append strategy: the fact loaded up to a watermark, then the rows past it."""
    full = w.fct_order
    old = full.where(F.col("order_ts") < F.lit(watermark_date).cast("timestamp_ntz"))
    return star.fact_increment(full, old, "append", watermark="order_ts", keys=["order_id"])
