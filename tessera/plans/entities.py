"""The integrated entities: order header, order detail and user events."""

from __future__ import annotations

from tessera.functions.timeofday import hms_to_millis_sql, millis_to_hms_sql
from tessera.operators.entity import DROP, FAIL, WARN, Entity, Rule


HEADER = Entity(
    name="order_header",
    keys=("order_id",),
    columns=(
        ("order_id", "CAST(order_id AS BIGINT)"),
        ("truck_id", "CAST(truck_id AS INT)"),
        ("location_id", "CAST(location_id AS INT)"),
        ("customer_id", "CAST(customer_id AS BIGINT)"),
        ("discount_id", "TRY_CAST(discount_id AS INT)"),
        ("shift_id", "CAST(shift_id AS INT)"),
        ("shift_start_time", millis_to_hms_sql("shift_start_time")),
        ("shift_end_time", millis_to_hms_sql("shift_end_time")),
        ("order_channel", "CAST(order_channel AS STRING)"),
        ("order_ts", "CAST(order_ts AS TIMESTAMP_NTZ)"),
        ("served_ts", "TRY_CAST(served_ts AS TIMESTAMP_NTZ)"),
        ("order_currency", "CAST(order_currency AS STRING)"),
        ("order_amount", "CAST(order_amount AS DECIMAL(38,4))"),
        ("order_tax_amount", "TRY_CAST(order_tax_amount AS DECIMAL(38,4))"),
        ("order_discount_amount", "TRY_CAST(order_discount_amount AS DECIMAL(38,4))"),
        ("order_total", "CAST(order_total AS DECIMAL(38,4))"),
    ),
    hash_columns=("truck_id", "location_id", "customer_id", "discount_id", "shift_id", "shift_start_time",
                  "shift_end_time", "order_channel", "order_ts", "served_ts", "order_currency", "order_amount",
                  "order_tax_amount", "order_discount_amount", "order_total"),
    # Rule names and conditions of the header rule set.
    rules=(
        Rule("order_ts_not_null", "order_ts IS NULL", DROP),
        Rule("customer_id_not_null", "customer_id IS NULL", DROP),
        Rule("order_currency_not_null", "order_currency IS NULL", DROP),
        Rule("order_total_non_negative", "order_total < 0", DROP),
        Rule("order_amount_non_negative", "order_amount < 0", DROP),
        Rule("truck_id_not_null", "truck_id IS NULL", WARN),
        Rule("location_id_not_null", "location_id IS NULL", WARN),
        Rule("shift_start_before_end", "shift_start_time > shift_end_time", WARN),
        Rule("order_id_not_null", "order_id IS NULL", FAIL),
    ),
    staged=(
        ("location_id", "CAST(location_id AS DOUBLE)"),
        ("shift_start_time", hms_to_millis_sql("shift_start_time")),
        ("shift_end_time", hms_to_millis_sql("shift_end_time")),
    ),
)

DETAIL = Entity(
    name="order_detail",
    keys=("order_detail_id",),
    columns=(
        ("order_detail_id", "CAST(order_detail_id AS BIGINT)"),
        ("order_id", "CAST(order_id AS BIGINT)"),
        ("line_number", "CAST(line_number AS INT)"),
        ("menu_item_id", "CAST(menu_item_id AS BIGINT)"),
        ("supplier_id", "CAST(supplier_id AS BIGINT)"),
        ("quantity", "CAST(quantity AS INT)"),
        ("unit_price", "CAST(unit_price AS DECIMAL(38,4))"),
        ("price", "CAST(price AS DECIMAL(38,4))"),
        ("order_item_discount_amount", "TRY_CAST(order_item_discount_amount AS DECIMAL(38,4))"),
        ("order_ts", "CAST(order_ts AS TIMESTAMP_NTZ)"),
    ),
    # Columns of the detail signature, in order.
    hash_columns=("order_id", "menu_item_id", "quantity", "unit_price", "price", "order_item_discount_amount",
                  "line_number"),
    # Rule names and conditions of the detail rule set.
    rules=(
        Rule("order_id_not_null", "order_id IS NULL", DROP),
        Rule("menu_item_id_not_null", "menu_item_id IS NULL", DROP),
        Rule("quantity_positive", "quantity <= 0", DROP),
        Rule("unit_price_non_negative", "unit_price < 0", DROP),
        Rule("price_non_negative", "price < 0", DROP),
        Rule("line_number_positive", "line_number <= 0", WARN),
        Rule("order_detail_id_not_null", "order_detail_id IS NULL", FAIL),
    ),
    tiebreak=("menu_item_id", "supplier_id"),
)

EVENTS = Entity(
    name="user_event",
    keys=("user_id",),
    columns=(
        ("user_id", "CAST(user_id AS BIGINT)"),
        ("event_id", "CAST(event_id AS BIGINT)"),
        ("event_type", "CAST(event_type AS STRING)"),
        ("value", "CAST(value AS DECIMAL(38,4))"),
    ),
    hash_columns=("event_id", "event_type", "value"),
    rules=(
        Rule("value_non_negative", "value < 0", DROP),
        Rule("event_type_not_null", "event_type IS NULL", WARN),
        Rule("user_id_not_null", "user_id IS NULL", FAIL),
    ),
    tiebreak=("event_id",),
)
