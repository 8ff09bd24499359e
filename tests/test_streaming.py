"""Pipes and tasks end to end with availableNow: stream == batch, each file
once, quarantine of bad rows, name-pattern filtering, by-name parquet."""
import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from helpers import SF001, rows
from tillroll import schemas
from tillroll.plans import silver, testmodel as tm
from tillroll.streaming import pipes, tasks
from test_iot import COLS as IOT_COLS, EXPECTED as IOT_EXPECTED, _write as write_events

POS_COLS = [f.name for f in schemas.POS_SILVER.fields
            if f.name not in ("source_file", "loaded_time", "process_time", "timezone")]

BAD_CSV = (",".join(schemas.POS_CSV_FIELDS) + "\n"
           '900001,1,"Store, One",Istanbul,Marmara,c1,u1,2023-01-05,10:00:00,sku1,"Tea, green",'
           'Drinks,Tea,2,10.5,5,21,Cash,3\n'                 # quoted commas: good
           "900002,1,Store,Istanbul,Marmara,c1,u1,2023-01-05,10:00:00,sku1\n"     # short
           "900003,1,Store,Istanbul,Marmara,c1,u1,2023-01-05,10:00:00,sku1,Tea,Drinks,Tea,"
           "2,10.5,5,21,Cash,3,EXTRA\n"                                            # long
           "900004,1,Store,Istanbul,Marmara,c1,u1,2023-01-05,10:00:00,sku1,Tea,Drinks,Tea,"
           "two,10.5,5,21,Cash,3\n"                                                # bad number
           "900005,1,Store,Istanbul,Marmara,c1,u1,2023-01-05,25:61:00,sku1,Tea,Drinks,Tea,"
           "-2,-10.5,-5,21,Cash,3\n")                                              # bad time


def _pos_text(spark):
    raw = tm.pos_raw(spark, SF001)
    return raw.select(*[F.col(c).cast("string").alias(c) for c in schemas.POS_CSV_FIELDS])


def _run(queries):
    for q in queries if isinstance(queries, list) else [queries]:
        q.awaitTermination()


def test_pos_pipe_and_task(spark, scratch):
    src, bronze, quarantine, silv = (f"{scratch}/{p}" for p in ("csv", "bronze", "quar", "silver"))
    ck = f"{scratch}/ck"
    text = _pos_text(spark)
    first = text.filter(F.col("transaction_date") < "1998-01-01")
    second = text.filter((F.col("transaction_date") >= "1998-01-01") | F.col("transaction_date").isNull())
    first.write.option("header", True).csv(f"{src}/2024-01-01")
    os.makedirs(f"{src}/2024-01-02")
    with open(f"{src}/2024-01-02/pos_edge.csv", "w") as f:
        f.write(BAD_CSV)

    bad_time = F.col("transaction_time") == tm.BAD_TIME_TEXT
    _run(pipes.pos_pipe(spark, src, bronze, quarantine, f"{ck}/pipe"))
    _run(pipes.pos_pipe(spark, src, bronze, quarantine, f"{ck}/pipe"))   # nothing new
    n1 = spark.read.parquet(bronze).count()
    assert n1 == first.filter(~bad_time).count() + 1
    q = spark.read.parquet(quarantine)
    edge_ids = F.col("transaction_id").isin("900001", "900002", "900003", "900004", "900005")
    assert q.filter(~edge_ids).count() == first.filter(bad_time).count()
    reasons = sorted(r[0] for r in q.filter(edge_ids).select("reason").collect())
    assert reasons == ["bad_quantity", "bad_timestamp", "malformed_row", "malformed_row"]
    edge = spark.read.parquet(bronze).filter("transaction_id = '900001'").collect()[0]
    assert edge.store_name == "Store, One" and edge.product_name == "Tea, green"

    second.write.option("header", True).csv(f"{src}/2024-01-03")
    _run(pipes.pos_pipe(spark, src, bronze, quarantine, f"{ck}/pipe"))
    assert spark.read.parquet(bronze).count() == n1 + second.filter(~bad_time).count()

    _run(tasks.pos_task(spark, bronze, silv, f"{ck}/task"))
    streamed = spark.read.parquet(silv).filter("transaction_id <> '900001'").select(*POS_COLS)
    batch = tm.pos_silver(spark, SF001).filter(F.col("transaction_date").isNotNull()) \
        .select(*POS_COLS)
    assert streamed.count() == batch.count()
    assert rows(streamed) == rows(batch)


def test_json_pipe_and_task(spark, scratch):
    write_events(f"{scratch}/json/2024-01-01", "array")
    _run(pipes.json_pipe(spark, f"{scratch}/json", f"{scratch}/bronze", f"{scratch}/ck/p"))
    _run(tasks.iot_task(spark, f"{scratch}/bronze", f"{scratch}/silver", f"{scratch}/ck/t"))
    got = spark.read.parquet(f"{scratch}/silver").select(*IOT_COLS)
    assert rows(got) == IOT_EXPECTED
    files = {r[0].rsplit("/", 1)[-1] for r in
             spark.read.parquet(f"{scratch}/silver").select("source_file").distinct().collect()}
    assert files == {"iot_events_batch_01.json", "iot_events_batch_02.json"}


def _orders_table(ids, qty, upper=False, drop=None, extra=False):
    n = len(ids)
    cols = {
        "order_id": ids, "order_date": [dt.date(2024, 1, 1)] * n, "store_id": ["S1"] * n,
        "store_city": ["Ist"] * n, "supplier_id": ["P1"] * n, "supplier_name": ["Sup"] * n,
        "supplier_city": ["Ank"] * n, "product_sku": ["sku"] * n, "category": ["Tea"] * n,
        "quantity_ordered": pa.array(qty, pa.int32()), "quantity_received": [0] * n,
        "unit_cost": [1.5] * n, "total_cost": [3.0] * n, "order_status": ["OPEN"] * n,
        "expected_delivery": [dt.date(2024, 1, 8)] * n, "actual_delivery": [None] * n,
        "warehouse_id": ["W"] * n, "lead_time_days": [7] * n, "is_late": [False] * n,
    }
    if drop:
        cols.pop(drop)
    if extra:
        cols["note"] = ["x"] * n
    t = pa.table(cols)
    if upper:
        t = t.rename_columns([c.upper() for c in t.column_names])
    return t


def test_orders_pipe_pattern_and_merge(spark, scratch):
    src = f"{scratch}/parquet/2024-01-01"
    os.makedirs(src)
    pq.write_table(_orders_table(["O1", "O2"], [5, 6]), f"{src}/erp_orders_a.parquet")
    pq.write_table(_orders_table(["O3"], [7], upper=True, drop="warehouse_id", extra=True),
                   f"{src}/ERP_orders_b.parquet")
    inv = pa.table({"snapshot_date": [dt.date(2024, 1, 1)], "store_id": ["S1"],
                    "warehouse_id": ["W"], "product_sku": ["sku"], "category": ["Tea"],
                    "quantity_on_hand": [3], "reorder_level": [1], "max_stock_level": [9],
                    "last_received_date": [dt.date(2024, 1, 1)]})
    pq.write_table(inv, f"{src}/erp_inventory_a.parquet")
    bronze, root = f"{scratch}/bronze", f"{scratch}/silver"
    _run(pipes.orders_pipe(spark, f"{scratch}/parquet", bronze, f"{scratch}/ck/p"))
    _run(pipes.inventory_pipe(spark, f"{scratch}/parquet", f"{scratch}/inv", f"{scratch}/ck/i"))
    b = spark.read.parquet(bronze)
    assert sorted(r[0] for r in b.select("order_id").collect()) == ["O1", "O2", "O3"]
    o3 = b.filter("order_id = 'O3'").collect()[0]
    assert o3.quantity_ordered == 7 and o3.warehouse_id is None
    assert spark.read.parquet(f"{scratch}/inv").count() == 1
    _run(tasks.orders_task(spark, bronze, root, f"{scratch}/ck/t"))
    # a later file updates O1
    src2 = f"{scratch}/parquet/2024-01-02"
    os.makedirs(src2)
    pq.write_table(_orders_table(["O1"], [50]), f"{src2}/erp_orders_c.parquet")
    _run(pipes.orders_pipe(spark, f"{scratch}/parquet", bronze, f"{scratch}/ck/p"))
    _run(tasks.orders_task(spark, bronze, root, f"{scratch}/ck/t"))
    cur = {r.order_id: r.quantity_ordered for r in tasks.read_current(spark, root).collect()}
    assert cur == {"O1": 50, "O2": 6, "O3": 7}
    assert silver.upsert_orders(spark.read.parquet(bronze)).count() == 3


def test_processing_time_task_runs_only_with_new_data(spark, scratch):
    """C4: a running task with a processing-time trigger picks up new bronze
    files and runs no batch while nothing new arrives."""
    import time
    staged = tm.pos_staging(spark, SF001)
    first, second = staged.limit(50), staged.filter("transaction_id = '1'")
    bronze, silv = f"{scratch}/bronze", f"{scratch}/silver"
    first.write.parquet(bronze)
    q = tasks.pos_task(spark, bronze, silv, f"{scratch}/ck", trigger="1 second")
    try:
        q.processAllAvailable()
        n_batches = len([p for p in q.recentProgress if p["numInputRows"] > 0])
        time.sleep(3)
        assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == n_batches
        second.write.mode("append").parquet(bronze)
        q.processAllAvailable()
        assert spark.read.parquet(silv).count() == 50 + second.count()
    finally:
        q.stop()


def test_old_files_are_read_and_a_foreign_checkpoint_is_refused(spark, scratch):
    import os
    import time

    import pytest
    src, bronze, ck = f"{scratch}/src", f"{scratch}/bronze", f"{scratch}/ck"
    os.makedirs(src)

    def land(name, i, age=0):
        line = f"{i},1,S,C,R,c,u,2023-01-05,10:00:00,sku,Tea,D,T,2,10.5,5,21,Cash,3"
        with open(f"{src}/{name}.csv", "w") as f:
            f.write(",".join(schemas.POS_CSV_FIELDS) + "\n" + line + "\n")
        os.utime(f"{src}/{name}.csv", (time.time() - age,) * 2)

    land("a", 1)
    _run(pipes.pos_pipe(spark, src, bronze, f"{scratch}/q", ck))
    land("b", 2, age=400 * 86400)
    land("c", 3)
    _run(pipes.pos_pipe(spark, src, bronze, f"{scratch}/q", ck))
    assert sorted(r.transaction_id for r in spark.read.parquet(bronze).collect()) == ["1", "2", "3"]
    with pytest.raises(RuntimeError):
        pipes.pos_pipe(spark, src, bronze, f"{scratch}/q", f"{scratch}/other")


def test_lakes_of_one_name_have_their_own_state(spark, scratch):
    from tillroll import jobs
    a, b = jobs.Lake(f"{scratch}/a"), jobs.Lake(f"{scratch}/b")
    assert a.checkpoint(spark, "x") != b.checkpoint(spark, "x")
    jobs.await_all(jobs.ingest(spark, a))  # nothing has landed: no folder is missed
