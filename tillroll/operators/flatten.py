"""Lateral unnest of nested sensor payloads (``FLATTEN`` twice).

A payload is an array of events; each event carries an array of readings.
Output is one row per reading.  Events with an empty, NULL or missing
``readings`` array yield no row (inner lateral semantics).  Both forms are
map-only ``Generate`` operators: no shuffle, and a file of any size is cut into
rows inside the task that reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tillroll.functions.expr import to_long_rounded


def _vget(v: Column, path: str, typ: str = "string") -> Column:
    return F.try_variant_get(v, path, typ)


def event_payload_as_array(payload: Column) -> Column:
    """Accept both file shapes: an outer array of events, or one event per
    line (an object).  An object is wrapped so that ``FLATTEN`` yields the
    event itself instead of its fields."""
    is_obj = F.schema_of_variant(payload).startswith("OBJECT")
    wrapped = F.to_variant_object(F.array(payload))
    return F.when(is_obj, wrapped).otherwise(payload)


def flatten_variant_events(spark: SparkSession, bronze: DataFrame,
                           payload: str = "raw_payload",
                           keep: tuple[str, ...] = ("source_file", "loaded_time")) -> DataFrame:
    """VARIANT path: ``LATERAL variant_explode`` over the payload, then over
    ``event.readings``.  Returns the typed reading rows (without process time).
    """
    base = bronze.select(*keep, event_payload_as_array(F.col(payload)).alias("_p"))
    evt = (base.lateralJoin(spark.tvf.variant_explode(F.col("_p").outer()).alias("e"))
           .select(*keep, F.col("value").alias("_evt")))
    rdg = (evt.lateralJoin(spark.tvf.variant_explode(
                _vget(F.col("_evt").outer(), "$.readings", "variant")).alias("r"))
           .select(*keep, "_evt", F.col("value").alias("_rdg")))
    e, r = F.col("_evt"), F.col("_rdg")
    return rdg.select(
        _vget(e, "$.event_id").alias("event_id"),
        _vget(e, "$.event_type").alias("event_type"),
        _vget(e, "$.store_id").alias("store_id"),
        _vget(e, "$.store_name").alias("store_name"),
        _vget(e, "$.timestamp").try_cast("timestamp_ntz").alias("event_ts"),
        _vget(e, "$.device_id").alias("device_id"),
        _vget(e, "$.metadata.firmware").alias("firmware"),
        to_long_rounded(_vget(e, "$.metadata.battery_pct", "double"), DoubleType()).alias("battery_pct"),
        to_long_rounded(_vget(e, "$.metadata.store_floor", "double"), DoubleType()).alias("store_floor"),
        _vget(r, "$.value", "double").alias("sensor_value"),
        _vget(r, "$.unit").alias("sensor_unit"),
        *keep,
        _vget(e, "$.alerts[0].alert_type").alias("alert_type"),
        _vget(e, "$.alerts[0].severity").alias("alert_severity"),
    )


def flatten_typed_events(events: DataFrame,
                         keep: tuple[str, ...] = ("source_file", "loaded_time")) -> DataFrame:
    """Typed path: input rows are events parsed with ``schemas.IOT_EVENT``
    (the JSON reader already split the outer array into rows).  ``inline``
    drops events whose ``readings`` is empty or NULL, like the VARIANT path.
    """
    rd = events.select("*", F.inline("readings").alias("rd_value", "rd_unit"))
    first_alert = F.get(F.col("alerts"), 0)
    return rd.select(
        "event_id", "event_type", "store_id", "store_name",
        F.col("timestamp").try_cast("timestamp_ntz").alias("event_ts"),
        "device_id",
        F.col("metadata.firmware").alias("firmware"),
        F.col("metadata.battery_pct").alias("battery_pct"),
        F.col("metadata.store_floor").alias("store_floor"),
        F.col("rd_value").alias("sensor_value"),
        F.col("rd_unit").alias("sensor_unit"),
        *keep,
        first_alert.getField("alert_type").alias("alert_type"),
        first_alert.getField("severity").alias("alert_severity"),
    )


def flatten(spark: SparkSession, df: DataFrame, column: str, outer: bool = False) -> DataFrame:
    """``LATERAL FLATTEN(INPUT => column)`` on a VARIANT column: one row per
    array element (``index``) or object field (``key``), with ``value``.
    Empty, NULL or scalar input yields no row unless ``outer``."""
    tvf = spark.tvf.variant_explode_outer if outer else spark.tvf.variant_explode
    return (df.lateralJoin(tvf(F.col(column).outer()))
              .withColumnRenamed("pos", "index"))
