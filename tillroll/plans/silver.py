"""Bronze → silver jobs.  Each is a pure DataFrame function, used unchanged by
the batch jobs and inside micro-batches (see :mod:`tillroll.streaming`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions.expr import (
    clamp_non_negative, time_text, to_double, to_long_rounded,
    ts_from_date_and_time, tz_offset_text,
)
from tillroll.operators.flatten import flatten_typed_events, flatten_variant_events
from tillroll.operators.latest import latest_per_key


def stage_pos(raw: DataFrame, source_file=None, loaded_time=None) -> DataFrame:
    """POS raw fields (text or typed) → staging row: casts, date+time combined
    into ``transaction_ts``, lineage.  ``source_file`` defaults to the scan's
    ``_metadata.file_path``; ``loaded_time`` to ``current_timestamp()`` (one
    value per query / micro-batch)."""
    src = F.col("_metadata.file_path") if source_file is None else source_file
    lt = F.current_timestamp() if loaded_time is None else loaded_time
    c = F.col
    return raw.select(
        c("transaction_id").cast("string"), c("store_id").cast("string"),
        c("store_name").cast("string"), c("store_city").cast("string"),
        c("store_region").cast("string"), c("cashier_id").cast("string"),
        c("customer_id").cast("string"), c("product_sku").cast("string"),
        c("product_name").cast("string"), c("category").cast("string"),
        c("subcategory").cast("string"),
        to_long_rounded("quantity", raw.schema["quantity"].dataType).alias("quantity"),
        to_double("unit_price").alias("unit_price"),
        to_double("discount_pct").alias("discount_pct"),
        to_double("total_amount").alias("total_amount"),
        c("payment_method").cast("string"),
        to_long_rounded("loyalty_points", raw.schema["loyalty_points"].dataType).alias("loyalty_points"),
        ts_from_date_and_time(c("transaction_date").cast("string"),
                              c("transaction_time").cast("string")).alias("transaction_ts"),
        src.cast("string").alias("source_file"),
        lt.cast("timestamp").alias("loaded_time"),
    )


def clean_pos(staging: DataFrame) -> DataFrame:
    """B1 ``silver_csv_transaction``: split timestamp, record the session
    offset, clamp negative quantity / price / discount to 0 (NULL kept),
    ``total_orderline = q⁺ · p⁺ · (1 − d⁺ / 100)``.  ``total_amount`` and
    ``loyalty_points`` pass through uncleaned.  Map-only."""
    q = clamp_non_negative("quantity")
    p = clamp_non_negative("unit_price")
    d = clamp_non_negative("discount_pct")
    c = F.col
    return staging.select(
        c("transaction_id"),
        F.to_date("transaction_ts").alias("transaction_date"),
        time_text("transaction_ts").alias("transaction_time"),
        tz_offset_text().alias("timezone"),
        "store_id", "store_name", "store_city", "store_region", "cashier_id",
        "customer_id", "product_sku", "product_name", "category", "subcategory",
        q.alias("quantity"), p.alias("unit_price"), d.alias("discount_pct"),
        "total_amount",
        ((q * p) * (F.lit(1) - (d / F.lit(100.0)))).alias("total_orderline"),
        "payment_method", "loyalty_points", "source_file", "loaded_time",
        F.current_timestamp().alias("process_time"),
    )


def flatten_iot(spark: SparkSession, bronze: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """B2 ``silver_iot_events`` from a VARIANT bronze table
    (``raw_payload, source_file, loaded_time``): one row per reading, first
    alert only, events without readings dropped, missing paths → NULL."""
    rows = flatten_variant_events(spark, bronze, payload)
    return rows.withColumn("processed_timestamp", F.current_timestamp()).select(
        *[f.name for f in schemas.IOT_SILVER.fields])


def flatten_iot_typed(events: DataFrame) -> DataFrame:
    """B2 over typed event rows (JSON read with ``schemas.IOT_EVENT``)."""
    rows = flatten_typed_events(events)
    return rows.withColumn("processed_timestamp", F.current_timestamp()).select(
        *[f.name for f in schemas.IOT_SILVER.fields])


ORDER_KEY = "order_id"
# Processing order of bronze versions: load time, then file; the remaining
# columns make the order total so that the winner is deterministic.
ORDER_SEQUENCE = ["loaded_time", "source_file"]


def upsert_orders(bronze: DataFrame) -> DataFrame:
    """B3 ``silver_erp_orders`` in definition form: the MERGE result after all
    bronze versions were applied = last processed version per ``order_id``.

    NULL keys never match in a MERGE, so each such row is inserted as is:
    they bypass the aggregation in a second branch.  Over a stored bronze
    table that branch is a scan with ``IsNull(order_id)`` pushed down, which
    parquet null-count statistics answer without reading row groups that
    hold no NULL key.
    """
    cols = [f.name for f in schemas.ERP_ORDERS_BRONZE.fields]
    keyed = bronze.filter(F.col(ORDER_KEY).isNotNull())
    latest = latest_per_key(keyed.select(*cols), ORDER_KEY, ORDER_SEQUENCE)
    nulls = bronze.filter(F.col(ORDER_KEY).isNull()).select(*cols)
    return (latest.unionByName(nulls)
            .withColumn("process_time", F.current_timestamp())
            .select(*[f.name for f in schemas.ERP_ORDERS_SILVER.fields]))


def stage_orders(raw: DataFrame, source_file=None, loaded_time=None) -> DataFrame:
    """ERP orders file rows → bronze row: per-column casts from the declared
    schema (``$1:col::TYPE``) plus lineage."""
    src = F.col("_metadata.file_path") if source_file is None else source_file
    lt = F.current_timestamp() if loaded_time is None else loaded_time
    out = []
    for f in schemas.ERP_ORDERS.fields:
        t = f.dataType.simpleString()
        if t == "bigint":
            out.append(to_long_rounded(f.name, raw.schema[f.name].dataType).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(t).alias(f.name))
    return raw.select(*out, lt.cast("timestamp").alias("loaded_time"),
                      src.cast("string").alias("source_file"))
