"""Readers: per-batch column normalisation (S22), glob vs full-path regex."""
import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq

from tillroll import schemas
from tillroll.sources import readers


def _orders(names, qty_type=pa.int64()):
    base = {"order_id": ["A"], "order_date": [dt.date(2024, 1, 1)], "store_id": ["S1"],
            "quantity_ordered": pa.array([5], qty_type), "unit_cost": [2.5], "is_late": [True]}
    return pa.table({names.get(k, k): v for k, v in base.items()})


def test_read_parquet_batches_conforms_names_order_and_widths(spark, scratch):
    pq.write_table(_orders({}), f"{scratch}/b1.parquet")
    t2 = _orders({"order_id": " Order ID ", "quantity_ordered": "QUANTITY-ORDERED",
                  "unit_cost": "Unit.Cost"}, pa.int32())
    t2 = t2.select(list(reversed(t2.column_names)))             # other column order
    pq.write_table(t2.append_column("extra", pa.array(["x"])), f"{scratch}/b2.parquet")
    df = readers.read_parquet_batches(spark, [f"{scratch}/b1.parquet", f"{scratch}/b2.parquet"],
                                      schemas.ERP_ORDERS)
    assert df.columns[:len(schemas.ERP_ORDERS.fields)] == [f.name for f in schemas.ERP_ORDERS.fields]
    got = sorted((r.order_id, r.quantity_ordered, r.unit_cost, r.is_late, r.supplier_id,
                  os.path.basename(r.source_file)) for r in df.collect())
    assert got == [("A", 5, 2.5, True, None, "b1.parquet"), ("A", 5, 2.5, True, None, "b2.parquet")]


def test_orders_glob_matches_base_name_regex_matches_path(spark, scratch):
    os.makedirs(f"{scratch}/stage/orders_dir")
    pq.write_table(_orders({}), f"{scratch}/stage/erp_orders_1.parquet")
    pq.write_table(_orders({}), f"{scratch}/stage/orders_dir/zz.parquet")
    pq.write_table(_orders({}), f"{scratch}/stage/erp_inventory_1.parquet")
    by_glob = readers.read_erp_orders(spark, f"{scratch}/stage")
    by_regex = readers.read_erp_orders(spark, f"{scratch}/stage",
                                       path_regex=readers.ORDERS_PATH_REGEX)
    names = lambda df: sorted(os.path.basename(r.source_file) for r in df.collect())
    assert names(by_glob) == ["erp_orders_1.parquet"]
    assert names(by_regex) == ["erp_orders_1.parquet", "zz.parquet"]


def test_read_parquet_batches_reads_every_footer(spark, scratch):
    os.makedirs(f"{scratch}/d1")
    pq.write_table(_orders({}), f"{scratch}/d1/a.parquet")
    pq.write_table(_orders({"order_id": "Order ID", "quantity_ordered": "Quantity Ordered"}, pa.float64()),
                   f"{scratch}/d1/b.parquet")
    pq.write_table(_orders({"order_id": "ORDER ID"}, pa.int32()), f"{scratch}/d1/c.parquet")
    files = [f"{scratch}/d1/{x}.parquet" for x in "abc"]
    df = readers.read_parquet_batches(spark, files, schemas.ERP_ORDERS)
    assert sorted((r.order_id, r.quantity_ordered) for r in df.collect()) == [("A", 5)] * 3


def test_bigints_are_exact(spark, scratch):
    big = 9007199254740993
    pq.write_table(pa.table({"order_id": ["A", "B"], "quantity_ordered": pa.array([big, -big])}), f"{scratch}/x.parquet")
    df = readers.read_parquet_batches(spark, [f"{scratch}/x.parquet"], schemas.ERP_ORDERS)
    assert sorted(r.quantity_ordered for r in df.collect()) == [-big, big]


def _csv(path, amounts):
    cols = schemas.POS_CSV_FIELDS
    with open(path, "w") as f:
        f.write(",".join(cols) + "\n")
        for i, a in enumerate(amounts):
            row = {c: "" for c in cols} | {"transaction_id": str(i), "transaction_date": "2024-01-02",
                                          "transaction_time": "10:00:00", "quantity": "1", "unit_price": a}
            f.write(",".join(row[c] for c in cols) + "\n")


def test_numbers_that_are_not_finite_or_too_large_are_quarantined(spark, scratch):
    _csv(f"{scratch}/a.csv", ["2.5", "NaN", "Infinity", "1e30", "x", "-3"])
    good, bad = readers.split_pos(readers.read_pos_csv(spark, scratch))
    assert sorted(r.unit_price for r in good.collect()) == [-3.0, 2.5]
    assert {r.reason for r in bad.collect()} == {"bad_unit_price"} and bad.count() == 4


EVENT = '{"event_id": "e%d", "event_type": "t", "readings": [{"value": 1.5, "unit": "kg"}], "alerts": []}'


def test_json_rows_are_good_or_quarantined(spark, scratch):
    with open(f"{scratch}/good.json", "w") as f:
        f.write("[" + ",".join(EVENT % i for i in range(50)) + "]")
    with open(f"{scratch}/open.json", "w") as f:
        f.write("[" + EVENT % 99)
    good, bad = readers.split_json(readers.read_json_records(spark, scratch))
    from tillroll.plans import silver
    assert silver.flatten_iot(spark, good).count() == 50
    rows = bad.collect()
    assert [os.path.basename(r.source_file) for r in rows] == ["open.json"] and "e99" in rows[0].record
