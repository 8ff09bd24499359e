"""End to end: files land → pipes → tasks → gold tables and views."""
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from helpers import SF001, rows
from tillroll import jobs, schemas
from tillroll.plans import catalog, silver, testmodel as tm


def _land(spark, lake):
    text = tm.pos_raw(spark, SF001).select(
        *[F.col(c).cast("string").alias(c) for c in schemas.POS_CSV_FIELDS])
    text.write.option("header", True).csv(f"{lake.csv_stage}/2024-01-01")
    ev = tm.iot_events(spark, SF001).select(F.to_json("event").alias("value"))
    ev.write.text(f"{lake.json_stage}/2024-01-01")
    orders = tm.erp_bronze(spark, SF001).select(*[f.name for f in schemas.ERP_ORDERS.fields])
    os.makedirs(f"{lake.parquet_stage}/2024-01-01")
    pq.write_table(pq.read_table(_to_parquet(spark, orders, lake)),
                   f"{lake.parquet_stage}/2024-01-01/erp_orders_001.parquet")


def _to_parquet(spark, df, lake):
    tmp = f"{lake.root}/_tmp_orders"
    df.coalesce(1).write.parquet(tmp)
    return [f"{tmp}/{f}" for f in os.listdir(tmp) if f.endswith(".parquet")][0]


def test_lake_end_to_end(spark, scratch):
    lake = jobs.Lake(scratch, name=os.path.basename(scratch))
    _land(spark, lake)
    jobs.await_all(jobs.ingest(spark, lake, json_layout="lines"))
    jobs.await_all(jobs.refine(spark, lake))
    out = jobs.build_gold(spark, lake)

    # gold fact from the lake == the batch fact over the same lines (rows whose
    # date/time text does not parse are in the quarantine instead)
    cols = ["store_id", "store_name", "store_city", "store_region", "category", "report_date",
            "total_revenue", "total_number_of_unit", "total_transaction", "unique_customers",
            "avg_cart"]
    batch_pos = tm.pos_silver(spark, SF001).filter(F.col("transaction_date").isNotNull())
    from tillroll.plans import gold
    want = catalog.present(gold.fact_decisions(batch_pos).select(*cols))
    got = catalog.present(out["fact_decisions"].select(*cols))
    assert rows(got) == rows(want)

    # sensor silver == the batch flatten
    icols = ["event_id", "event_type", "store_id", "store_name", "event_ts", "firmware",
             "battery_pct", "store_floor", "sensor_value", "sensor_unit", "alert_type",
             "alert_severity"]
    assert rows(out["silver_iot_events"].select(*icols)) == \
        rows(tm.iot_silver(spark, SF001).select(*icols))

    # orders: one current row per order id
    keys = out["silver_erp_orders"].select("order_id")
    assert keys.count() == keys.distinct().count() == \
        silver.upsert_orders(tm.erp_bronze(spark, SF001)).count()

    # a load-window read of bronze prunes ingest-day folders
    win = jobs.load_time_window(spark.read.parquet(lake.bronze("pos")), "2000-01-01 00:00:00")
    plan = win._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert win.count() == spark.read.parquet(lake.bronze("pos")).count()

    # views are registered and queryable
    n = spark.sql("SELECT count(*) FROM fact_sales_verses_iot").collect()[0][0]
    assert n == out["fact_sales_verses_iot"].count() > 0
    assert spark.sql("SELECT * FROM row_counts").count() == 6

    # a refresh of the touched days (here all) equals the rebuild; one of none changes nothing
    before = rows(out["fact_decisions"].select(*cols))
    newest = out["silver_csv_transaction"].agg(F.max("process_time")).first()[0]
    for since in ("2000-01-01 00:00:00", newest):
        again = jobs.build_gold(spark, lake, since)
        assert rows(again["fact_decisions"].select(*cols)) == before


GOLD = {"fact_decisions": "report_date", "fact_iot_store_daily": "event_date", "fact_sales_verses_iot": "report_date",
        "fact_gross_margin": None, "matelized_view_category_by_region": None}


def _files(lake, table):
    return {f"{d}/{f}" for d, _, names in os.walk(lake.gold(table)) for f in names if f.endswith(".parquet")}


def test_refresh_takes_in_changes_and_leaves_other_days_alone(spark, scratch):
    lake = jobs.Lake(f"{scratch}/lake")
    text = tm.pos_raw(spark, SF001).select(*[F.col(c).cast("string").alias(c) for c in schemas.POS_CSV_FIELDS])
    # two months that have sensor events; every report day is a folder
    text = text.filter((F.col("transaction_time") != tm.BAD_TIME_TEXT) & F.col("transaction_date").between("1998-01-01", "1998-02-28"))
    days = sorted(r[0] for r in text.select("transaction_date").distinct().collect() if r[0])
    late = F.coalesce(F.col("transaction_date"), F.lit("")) >= days[-5]
    orders = tm.erp_bronze(spark, SF001)
    order_fields = [f.name for f in schemas.ERP_ORDERS.fields]
    cut = F.col("loaded_time") >= F.lit("1997-01-01").cast("timestamp")
    events = tm.iot_events(spark, SF001).select(F.to_json("event").alias("value"))
    last_event = F.col("value").contains(f'"timestamp":"{days[-3]}')

    def land(day, lines, sensor, erp):
        lines.write.option("header", True).csv(f"{lake.csv_stage}/{day}")
        sensor.write.text(f"{lake.json_stage}/{day}")
        os.makedirs(f"{lake.parquet_stage}/{day}")
        name = f"{lake.parquet_stage}/{day}/erp_orders_{day}.parquet"
        tmp = f"{scratch}/tmp-{day}"
        erp.select(*order_fields).coalesce(1).write.parquet(tmp)
        os.rename(next(f"{tmp}/{f}" for f in os.listdir(tmp) if f.endswith(".parquet")), name)
        jobs.await_all(jobs.ingest(spark, lake, json_layout="lines"))
        jobs.await_all(jobs.refine(spark, lake))

    land("2024-01-01", text.filter(~late), events.filter(~last_event), orders.filter(~cut))
    jobs.refresh_gold(spark, lake)
    before = {t: _files(lake, t) for t in GOLD}
    redelivered = text.filter(F.col("transaction_date") == days[0])
    land("2024-01-02", text.filter(late).unionByName(redelivered), events.filter(last_event), orders.filter(cut))
    taken = jobs.refresh_gold(spark, lake)
    assert {str(d) for d in taken["pos"]} == {*days[-5:], days[0]}
    for table in ("fact_decisions", "fact_sales_verses_iot"):
        kept = {f for f in before[table] if not any(f"report_date={d}" in f for d in (*days[-5:], days[0]))}
        assert kept and kept <= _files(lake, table)

    def content():
        spark.catalog.clearCache()
        return {t: rows(catalog.present(spark.read.parquet(lake.gold(t)).drop("load_timestamp"))) for t in GOLD}

    refreshed = content()
    at = {t: _files(lake, t) for t in GOLD}
    assert jobs.refresh_gold(spark, lake) == {"pos": set(), "iot": set()} and at == {t: _files(lake, t) for t in GOLD}
    # every landed file is accounted for, and all rows are in some file
    found = jobs.load_outcomes(spark, lake)
    assert {r.status for r in found.collect()} == {"LOADED"}
    assert found.agg(F.sum("rows_loaded")).first()[0] == sum(spark.read.parquet(lake.bronze(t)).count() for t in ("pos", "iot", "orders"))
    # the distinct counts that the two refreshes kept are those of all lines
    month = F.trunc("transaction_date", "MM").alias("sales_month")
    lines = jobs.silver_tables(spark, lake)["silver_csv_transaction"]
    plain = lines.groupBy(month).agg(F.count_distinct("transaction_id").alias("unique_transaction_id"),
                                     F.count_distinct("customer_id").alias("unique_customer_id"))
    assert rows(jobs.gold_tables(spark, lake)["distinct_by_month"]) == rows(plain)
    jobs.build_gold(spark, lake)
    assert content() == refreshed
    assert len(refreshed["fact_gross_margin"]) > 0 and len(refreshed["fact_sales_verses_iot"]) > 0
