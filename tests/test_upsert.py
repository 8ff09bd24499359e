"""Upsert: definition form == incremental MERGE per micro-batch."""
from pyspark.sql import functions as F

from helpers import SF001, rows
from tillroll import schemas
from tillroll.operators import changes
from tillroll.plans import silver, testmodel as tm
from tillroll.streaming import commit, merge, tasks

SILVER_COLS = [f.name for f in schemas.ERP_ORDERS_SILVER.fields if f.name != "process_time"]


def test_latest_version_wins_and_null_keys_survive(spark):
    b = tm.erp_bronze(spark, SF001)
    first = b.limit(2).collect()
    extra = spark.createDataFrame(
        [r.asDict() | {"order_id": None} for r in first] * 2, schemas.ERP_ORDERS_BRONZE)
    out = silver.upsert_orders(b.unionByName(extra))
    assert out.filter(F.col("order_id").isNull()).count() == 4
    assert out.filter(F.col("order_id").isNotNull()).count() == \
        b.select("order_id").distinct().count()


def test_incremental_merge_equals_definition(spark, scratch):
    bronze = tm.erp_bronze(spark, SF001)
    days = sorted(r[0] for r in bronze.select(F.to_date("loaded_time")).distinct().collect())
    cuts = [days[len(days) // 3], days[2 * len(days) // 3]]
    batches = [bronze.filter(F.to_date("loaded_time") < cuts[0]),
               bronze.filter((F.to_date("loaded_time") >= cuts[0]) & (F.to_date("loaded_time") < cuts[1])),
               bronze.filter(F.to_date("loaded_time") >= cuts[1])]
    root = f"{scratch}/silver_orders"
    for i, bt in enumerate(batches):
        tasks.merge_batch(spark, root, bt, i)
    tasks.merge_batch(spark, root, batches[1], 1)          # replayed batch: idempotent
    assert tasks.generations(spark, root) == [0, 1, 2]
    incremental = tasks.read_current(spark, root).select(*SILVER_COLS)
    definition = silver.upsert_orders(bronze).select(*SILVER_COLS)
    assert incremental.count() == definition.count()
    assert rows(incremental) == rows(definition)


def _batches(spark):
    bronze = tm.erp_bronze(spark, SF001)
    days = sorted(r[0] for r in bronze.select(F.to_date("loaded_time")).distinct().collect())
    cut = days[2 * len(days) // 3]
    return bronze.filter(F.to_date("loaded_time") < cut), bronze.filter(F.to_date("loaded_time") >= cut)


def test_change_rows_equal_the_diff_of_the_two_states(spark, scratch):
    first, second = _batches(spark)
    root, log = f"{scratch}/orders", f"{scratch}/changes"
    loose = first.limit(3).withColumn("order_id", F.lit(None).cast("string"))
    for i, batch in enumerate((first, second.unionByName(loose), first.limit(0))):
        for _ in range(2):                                                       # each batch is replayed
            tasks.merge_batch(spark, root, batch, i, log)
    names = SILVER_COLS + ["change_action", "change_isupdate"]
    got = spark.read.parquet(log).select(*names)
    old = tasks.read_current(spark, root, before=1)
    new = tasks.read_current(spark, root)
    assert new.count() == old.count() + 3 + new.join(old, "order_id", "left_anti").filter("order_id is not null").count()
    diff = changes.snapshot_diff(old, new, "order_id", [c for c in SILVER_COLS if c != "order_id"])
    begun = changes.snapshot_diff(old.limit(0), old, "order_id", [c for c in SILVER_COLS if c != "order_id"])
    assert diff.filter("change_isupdate").count() > 0
    assert rows(got.filter("order_id is not null")) == rows(diff.unionByName(begun).select(*names))
    assert got.filter("order_id is null").count() == 3
    figures = {r.batch_id: r.rows for r in commit.load_figures(spark, log).collect()}
    assert figures == {0: begun.count(), 1: diff.count() + 3, 2: 0}


def test_a_batch_rewrites_only_its_buckets(spark, scratch):
    first, second = _batches(spark)
    root = f"{scratch}/orders"
    tasks.merge_batch(spark, root, first, 0)
    before = merge.manifest(spark, root)
    few = second.filter(F.col("order_id") == second.first().order_id)
    tasks.merge_batch(spark, root, few, 1)
    after = merge.manifest(spark, root)
    assert len(before["gens"]) == merge.BUCKETS
    assert [b for b in after["gens"] if after["gens"][b] != before["gens"][b]] == [
        str(r[0]) for r in few.select(merge.bucket_of("order_id", merge.BUCKETS)).distinct().collect()]
    both = silver.upsert_orders(first.unionByName(few)).select(*SILVER_COLS)
    assert rows(tasks.read_current(spark, root).select(*SILVER_COLS)) == rows(both)
    tasks.merge_batch(spark, root, second, 2)
    final = rows(tasks.read_current(spark, root))
    assert merge.vacuum(spark, root) > 0 and rows(tasks.read_current(spark, root)) == final
    assert rows(tasks.read_current(spark, root, before=2).select(*SILVER_COLS)) == rows(both)


def test_a_merge_that_broke_off_is_done_again(spark, scratch, monkeypatch):
    import pytest
    first, second = _batches(spark)
    root, log = f"{scratch}/orders", f"{scratch}/changes"
    tasks.merge_batch(spark, root, first, 0, log)
    monkeypatch.setattr(merge, "put_file", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tasks.merge_batch(spark, root, second, 1, log)
    assert tasks.generations(spark, root) == [0] and tasks.read_current(spark, root).count() == \
        silver.upsert_orders(first).count()
    monkeypatch.undo()
    tasks.merge_batch(spark, root, second, 1, log)
    whole = silver.upsert_orders(first.unionByName(second)).select(*SILVER_COLS)
    assert rows(tasks.read_current(spark, root).select(*SILVER_COLS)) == rows(whole)
    assert {r.batch_id for r in commit.load_figures(spark, log).collect()} == {0, 1}


def test_a_merge_moves_each_row_once_and_caches_none(spark, scratch, monkeypatch):
    from pyspark.sql import DataFrame
    first, second = _batches(spark)
    root, log = f"{scratch}/orders", f"{scratch}/changes"
    monkeypatch.setattr(DataFrame, "persist", lambda *a: 1 / 0)
    monkeypatch.setattr(merge, "PART_ROWS", 40, raising=False)                     # a bucket is several files
    for i, batch in enumerate((first, second)):
        tasks.merge_batch(spark, root, batch, i, log)
    whole = silver.upsert_orders(first.unionByName(second)).select(*SILVER_COLS)
    assert rows(tasks.read_current(spark, root).select(*SILVER_COLS)) == rows(whole)
    assert len(merge.manifest(spark, root)["gens"]) < len(tasks.read_current(spark, root).inputFiles())
    old, new = tasks.read_current(spark, root, before=1), tasks.read_current(spark, root)
    diff = changes.snapshot_diff(old, new, "order_id", [c for c in SILVER_COLS if c != "order_id"])
    got = tasks.read_changes(spark, log, 0).select(*SILVER_COLS, "change_action", "change_isupdate")
    assert rows(got) == rows(diff.select(*got.columns))


def _shuffled(spark):
    """Bytes that shuffles hold on the executor's disks."""
    import glob
    import os
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    total = 0
    for f in [f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*")]:
        try:
            total += os.path.getsize(f)
        except FileNotFoundError:                                                # goes just now
            pass
    return total


def test_moved_rows_leave_the_disk_with_their_merge(spark, scratch, monkeypatch):
    import time
    batch = tm.erp_bronze(spark, SF001).localCheckpoint()
    name, seen, write = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], merge._write
    monkeypatch.setattr(merge, "_write", lambda *a: seen.append(spark.conf.get(name)) or write(*a))
    before = _shuffled(spark)
    tasks.merge_batch(spark, f"{scratch}/orders", batch, 0, f"{scratch}/changes")
    assert seen == ["true"] and spark.conf.get(name) == "false"                  # not left to the driver's garbage
    for _ in range(50):
        if _shuffled(spark) - before < 100_000:
            break
        time.sleep(0.1)
    assert _shuffled(spark) - before < 100_000                                   # about 700 KB are moved


def test_a_large_batch_moves_some_buckets_at_a_time(spark, scratch, monkeypatch):
    first, second = _batches(spark)
    root, log, groups = f"{scratch}/orders", f"{scratch}/changes", []
    write = merge._write
    monkeypatch.setattr(merge, "_write", lambda *a: groups.append(a[-1]) or write(*a))
    monkeypatch.setattr(merge, "MOVED_ROWS", 1000)
    for i, batch in enumerate((first, second)):
        tasks.merge_batch(spark, root, batch, i, log)
        assert len(groups) > 2 and sorted(sum(groups, [])) == list(range(merge.BUCKETS))
        assert max(map(len, groups)) < merge.BUCKETS / 2
        groups.clear()
    whole = silver.upsert_orders(first.unionByName(second)).select(*SILVER_COLS)
    old, new = tasks.read_current(spark, root, before=1), tasks.read_current(spark, root)
    assert rows(new.select(*SILVER_COLS)) == rows(whole)
    assert new.filter(F.col("process_time") > old.agg(F.max("process_time")).first()[0]).select("process_time").distinct().count() == 1
    diff = changes.snapshot_diff(old, new, "order_id", [c for c in SILVER_COLS if c != "order_id"])
    got = tasks.read_changes(spark, log, 0).select(*SILVER_COLS, "change_action", "change_isupdate")
    assert got.filter("change_isupdate").count() > 0 and rows(got) == rows(diff.select(*got.columns))
    assert merge._groups({1: 999, 2: 1, 3: 5000, 4: 600, 5: 600}) == [[1, 2], [3], [4], [5]]


def test_a_merge_that_keeps_one_state_drops_the_others(spark, scratch):
    import glob

    import pytest
    first, second = _batches(spark)
    root, log = f"{scratch}/orders", f"{scratch}/changes"
    for i, batch in enumerate((first, second, first.limit(0))):
        tasks.merge_batch(spark, root, batch, i, log, keep=1)
    whole = silver.upsert_orders(first.unionByName(second)).select(*SILVER_COLS)
    assert rows(tasks.read_current(spark, root).select(*SILVER_COLS)) == rows(whole)
    gens = glob.glob(f"{root}/bucket=*/gen=*")
    assert len(gens) == len(merge.manifest(spark, root)["gens"])                  # none that no state reads
    assert not glob.glob(f"{root}/{merge.REPLACED}/gen=*") and not glob.glob(f"{root}/_aside/gen=*")
    assert tasks.read_changes(spark, log).filter("change_action = 'DELETE'").count() > 0
    assert "_old" not in spark.read.parquet(gens[0]).columns
    tasks.merge_batch(spark, root, first, 2, log, keep=1)                         # a replay does nothing
    with pytest.raises(ValueError):
        tasks.merge_batch(spark, root, first, 0, log)                             # its state is gone
