"""Nested sensor payloads: VARIANT and typed paths, both file layouts."""
import json
import os

from helpers import SF001, rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.plans import gold, silver, testmodel as tm
from tillroll.sources import readers

EVENTS = [
    {"event_id": "e1", "event_type": "entrance_gate", "store_id": "S1", "store_name": "Ist",
     "timestamp": "2023-03-01 10:00:00", "device_id": "d1",
     "metadata": {"firmware": "v1", "battery_pct": 80, "store_floor": 1},
     "readings": [{"value": 3.0, "unit": "count"}, {"value": 40.0, "unit": "percent"}],
     "alerts": [{"alert_type": "door", "severity": "low"}, {"alert_type": "x", "severity": "y"}]},
    {"event_id": "e2", "event_type": "cold_storage", "store_id": "S1", "store_name": "Ist",
     "timestamp": "2023-03-01 11:00:00", "device_id": "d2",
     "readings": [], "alerts": []},                                  # empty readings: dropped
    {"event_id": "e3", "event_type": "energy_meter", "store_id": "S2", "store_name": "Izm",
     "timestamp": "2023-03-02 09:30:00", "device_id": "d3",
     "readings": [{"value": 2.5, "unit": "KG_net"}]},                # no metadata, no alerts
    {"event_id": "e4", "event_type": "pos_terminal", "store_id": "S2", "store_name": "Izm",
     "timestamp": "2023-03-02 09:31:00", "device_id": "d4"},         # readings missing
]

EXPECTED = sorted([
    # alert_severity, alert_type, battery_pct, device_id, event_id, event_type, firmware,
    # sensor_unit, sensor_value, store_floor, store_id, store_name
    ("low", "door", 80, "d1", "e1", "entrance_gate", "v1", "count", 3.0, 1, "S1", "Ist"),
    ("low", "door", 80, "d1", "e1", "entrance_gate", "v1", "percent", 40.0, 1, "S1", "Ist"),
    (None, None, None, "d3", "e3", "energy_meter", None, "KG_net", 2.5, None, "S2", "Izm"),
], key=lambda t: tuple((x is None, str(x)) for x in t))

COLS = ["alert_severity", "alert_type", "battery_pct", "device_id", "event_id", "event_type",
        "firmware", "sensor_unit", "sensor_value", "store_floor", "store_id", "store_name"]


def _write(folder, layout):
    os.makedirs(folder, exist_ok=True)
    if layout == "array":
        with open(f"{folder}/iot_events_batch_01.json", "w") as f:
            json.dump(EVENTS[:2], f)
        with open(f"{folder}/iot_events_batch_02.json", "w") as f:
            json.dump(EVENTS[2:], f)
    else:
        with open(f"{folder}/iot_events.ndjson.json", "w") as f:
            f.write("\n".join(json.dumps(e) for e in EVENTS) + "\n")


def test_variant_and_typed_paths_agree(spark, scratch):
    for layout in ("array", "lines"):
        folder = f"{scratch}/{layout}"
        _write(folder, layout)
        bronze = readers.read_json_payload(spark, folder, layout)
        via_variant = silver.flatten_iot(spark, bronze).select(*COLS)
        typed = readers.read_json_events_typed(spark, folder, layout)
        via_typed = silver.flatten_iot_typed(typed).select(*COLS)
        assert rows(via_variant) == EXPECTED, layout
        assert rows(via_typed) == EXPECTED, layout


def test_event_ts_parsed(spark, scratch):
    _write(scratch, "array")
    out = silver.flatten_iot(spark, readers.read_json_payload(spark, scratch))
    ts = sorted(str(r[0]) for r in out.select("event_ts").collect())
    assert ts == ["2023-03-01 10:00:00", "2023-03-01 10:00:00", "2023-03-02 09:30:00"]


def _fanout(pos: DataFrame, iot: DataFrame) -> DataFrame:
    """The join of every line with every reading, to check the linear form against."""
    t = pos.select("store_id", "store_name", "transaction_id", "total_orderline",
                   F.to_date("transaction_date").alias("sale_date"))
    s = iot.filter(gold._kg_unit(F.col("sensor_unit"))).select(
        F.col("store_id").alias("_sid"), F.to_date("event_ts").alias("_d"), "sensor_value")
    j = t.join(s, (F.col("store_id") == F.col("_sid")) & (F.col("sale_date") == F.col("_d")))
    return (j.groupBy("store_id", "store_name", "sale_date")
             .agg(gold.exact_sum("total_orderline").alias("total_revenue"),
                  F.count_distinct("transaction_id").alias("unique_transactions"),
                  F.avg("sensor_value").alias("avg_self_value")))


def test_kg_join_rewrite_equals_fanout(spark):
    pos, iot = tm.pos_silver(spark, SF001), tm.iot_silver(spark, SF001)
    from tillroll.plans.catalog import present
    fast = present(gold.sales_kg_sensor(pos, iot))
    slow = present(_fanout(pos, iot))
    assert fast.count() > 0
    assert rows(fast) == rows(slow)


def test_flatten_array_object_and_empty(spark):
    from pyspark.sql import functions as F
    from tillroll.operators.flatten import flatten
    df = spark.createDataFrame([(1, '[10, 20]'), (2, '{"a": 1, "b": 2}'), (3, '[]'), (4, None)],
                               "id int, s string").select("id", F.parse_json("s").alias("v"))
    inner = flatten(spark, df, "v").select("id", "index", "key",
                                           F.to_json("value").alias("value"))
    assert sorted(tuple(r) for r in inner.collect()) == [
        (1, 0, None, "10"), (1, 1, None, "20"), (2, 0, "a", "1"), (2, 1, "b", "2")]
    outer = flatten(spark, df, "v", outer=True)
    assert sorted(r.id for r in outer.collect()) == [1, 1, 2, 2, 3, 4]
