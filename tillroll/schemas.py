"""Declared table schemas of the retail model.

Fixed values (must equal the declared model): INT columns are BIGINT, FLOAT
columns are DOUBLE, TIME is ``'HH:mm:ss'`` text, event/order times are
TIMESTAMP_NTZ and load/process times are TIMESTAMP.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, LongType, StringType,
    StructField, StructType, TimestampNTZType, TimestampType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, D, DT, B = StringType(), LongType(), DoubleType(), DateType(), BooleanType()
NTZ, TS = TimestampNTZType(), TimestampType()

# Raw POS CSV, 19 fields bound by position.  Everything is read as text; the
# staging load casts (so one bad number cannot fail a file).
POS_CSV_FIELDS = [
    "transaction_id", "store_id", "store_name", "store_city", "store_region",
    "cashier_id", "customer_id", "transaction_date", "transaction_time",
    "product_sku", "product_name", "category", "subcategory", "quantity",
    "unit_price", "discount_pct", "total_amount", "payment_method",
    "loyalty_points",
]
POS_CSV_TEXT = _s(*[(n, S) for n in POS_CSV_FIELDS])

# Typed raw POS table (positional bulk load).
POS_RAW = _s(
    ("transaction_id", S), ("store_id", S), ("store_name", S), ("store_city", S),
    ("store_region", S), ("cashier_id", S), ("customer_id", S),
    ("transaction_date", DT), ("transaction_time", S), ("product_sku", S),
    ("product_name", S), ("category", S), ("subcategory", S), ("quantity", L),
    ("unit_price", D), ("discount_pct", D), ("total_amount", D),
    ("payment_method", S), ("loyalty_points", L),
)

POS_STAGING = _s(
    ("transaction_id", S), ("store_id", S), ("store_name", S), ("store_city", S),
    ("store_region", S), ("cashier_id", S), ("customer_id", S), ("product_sku", S),
    ("product_name", S), ("category", S), ("subcategory", S), ("quantity", L),
    ("unit_price", D), ("discount_pct", D), ("total_amount", D),
    ("payment_method", S), ("loyalty_points", L), ("transaction_ts", NTZ),
    ("source_file", S), ("loaded_time", TS),
)

POS_SILVER = _s(
    ("transaction_id", S), ("transaction_date", DT), ("transaction_time", S),
    ("timezone", S), ("store_id", S), ("store_name", S), ("store_city", S),
    ("store_region", S), ("cashier_id", S), ("customer_id", S), ("product_sku", S),
    ("product_name", S), ("category", S), ("subcategory", S), ("quantity", L),
    ("unit_price", D), ("discount_pct", D), ("total_amount", D),
    ("total_orderline", D), ("payment_method", S), ("loyalty_points", L),
    ("source_file", S), ("loaded_time", TS), ("process_time", TS),
)

ERP_ORDER_FIELDS = [
    ("order_id", S), ("order_date", DT), ("store_id", S), ("store_city", S),
    ("supplier_id", S), ("supplier_name", S), ("supplier_city", S),
    ("product_sku", S), ("category", S), ("quantity_ordered", L),
    ("quantity_received", L), ("unit_cost", D), ("total_cost", D),
    ("order_status", S), ("expected_delivery", DT), ("actual_delivery", DT),
    ("warehouse_id", S), ("lead_time_days", L), ("is_late", B),
]
ERP_ORDERS = _s(*ERP_ORDER_FIELDS)
ERP_ORDERS_BRONZE = _s(*ERP_ORDER_FIELDS, ("loaded_time", TS), ("source_file", S))
ERP_ORDERS_SILVER = _s(*ERP_ORDER_FIELDS, ("loaded_time", TS), ("source_file", S),
                       ("process_time", TS))

ERP_INVENTORY = _s(
    ("snapshot_date", DT), ("store_id", S), ("warehouse_id", S),
    ("product_sku", S), ("category", S), ("quantity_on_hand", L),
    ("reorder_level", L), ("max_stock_level", L), ("last_received_date", DT),
)

# One IoT event as typed JSON (the typed reader path).
IOT_EVENT = _s(
    ("event_id", S), ("event_type", S), ("store_id", S), ("store_name", S),
    ("timestamp", S), ("device_id", S),
    ("metadata", _s(("firmware", S), ("battery_pct", L), ("store_floor", L))),
    ("readings", ArrayType(_s(("value", D), ("unit", S)))),
    ("alerts", ArrayType(_s(("alert_type", S), ("severity", S)))),
)

IOT_SILVER = _s(
    ("event_id", S), ("event_type", S), ("store_id", S), ("store_name", S),
    ("event_ts", NTZ), ("device_id", S), ("firmware", S), ("battery_pct", L),
    ("store_floor", L), ("sensor_value", D), ("sensor_unit", S),
    ("source_file", S), ("loaded_time", TS), ("processed_timestamp", TS),
    ("alert_type", S), ("alert_severity", S),
)

# Landing status ledger: one row per status event, never updated in place.
LEDGER = _s(
    ("file_id", S), ("original_file_id", S), ("file_name", S), ("status", S),
    ("s3_path", S), ("updated_at", S),
)

# Landing statuses.
STATUS_DOWNLOADING = "DOWNLOADING"
STATUS_UPLOADING = "UPLOADING"
STATUS_UPLOADED = "UPLOADED"
STATUS_DELETED = "DELETED"
STATUS_ALREADY_EXISTS = "ALREADY_EXISTS"
STATUS_SKIPPED_NOT_JSON = "SKIPPED_NOT_JSON"
STATUS_SKIPPED_INVALID_FILE = "SKIPPED_INVALID_FILE"
