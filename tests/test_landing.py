"""Landing: extension gate, dated keys, existing keys, ledger, current view."""
import datetime as dt
import os

from pyspark.sql import functions as F

from tillroll.sources import landing

T = dt.datetime


def _listing(spark):
    return spark.createDataFrame([
        ("drive", "d1", "events.JSON", 10, T(2024, 1, 2, 8)),
        ("drive", "d2", "notes.xlsx", 10, T(2024, 1, 2, 8)),
        ("drive", "d3", "noext", 10, T(2024, 1, 2, 8)),
        ("drive", "d4", "old.json", 10, T(2024, 1, 1, 8)),
        ("ftp", "f1", "pos.csv", 10, T(2024, 1, 2, 9)),
        ("ftp", "f2", "orders.Parquet", 10, T(2024, 1, 2, 9)),
        ("ftp", "f3", "page.html", 10, T(2024, 1, 2, 9)),
    ], "feed string, file_ref string, file_name string, length bigint, modified_at timestamp_ntz")


def test_classify_and_keys(spark):
    c = landing.classify(_listing(spark), F.to_date("modified_at"))
    got = {r.file_ref: (r.accepted, r.skip_status, r.landing_key) for r in c.collect()}
    assert got == {
        "d1": (True, None, "json/2024-01-02/events.JSON"),
        "d2": (False, "SKIPPED_NOT_JSON", None),
        "d3": (False, "SKIPPED_NOT_JSON", None),
        "d4": (True, None, "json/2024-01-01/old.json"),
        "f1": (True, None, "ftp/csv/2024-01-02/pos.csv"),
        "f2": (True, None, "ftp/parquet/2024-01-02/orders.Parquet"),
        "f3": (False, "SKIPPED_INVALID_FILE", None),
    }


def test_ledger_sequence_and_current_status(spark):
    c = landing.classify(_listing(spark), F.to_date("modified_at"))
    store = spark.createDataFrame([("json/2024-01-01/old.json",), ("json/2024-01-01/old.json",)],
                                  "key string")
    m = landing.mark_existing(c, store)
    assert {r.file_ref for r in m.filter("already_exists").collect()} == {"d4"}
    ledger = landing.status_events(m, F.lit("2024-01-02 00:05:00").cast("timestamp_ntz"))
    seq = [r.status for r in ledger.filter("original_file_id = 'd1'").orderBy("updated_at").collect()]
    assert seq == ["DOWNLOADING", "UPLOADING", "UPLOADED", "DELETED"]
    seq = [r.status for r in ledger.filter("original_file_id = 'f1'").orderBy("updated_at").collect()]
    assert seq == ["UPLOADING", "UPLOADED", "DELETED"]
    d1 = ledger.filter("original_file_id = 'd1'").orderBy("updated_at").collect()
    assert [r.s3_path for r in d1] == ["", "", "json/2024-01-02/events.JSON"] * 1 + \
        ["json/2024-01-02/events.JSON"]
    assert d1[0].updated_at == "2024-01-02 00:05:00"          # no fraction at whole seconds
    assert d1[0].file_id == "d1_1704153900.000000"
    cur = {r.original_file_id: r.status for r in landing.current_status(ledger).collect()}
    assert cur == {"d1": "DELETED", "d2": "SKIPPED_NOT_JSON", "d3": "SKIPPED_NOT_JSON",
                   "d4": "ALREADY_EXISTS", "f1": "DELETED", "f2": "DELETED",
                   "f3": "SKIPPED_INVALID_FILE"}
    top = landing.latest_events(ledger, 3).collect()
    # newest: d1 DELETED (+3 s); then three events at +2 s, ties by file_id desc
    assert [(r.original_file_id, r.status) for r in top] == [
        ("d1", "DELETED"), ("f2", "DELETED"), ("f1", "DELETED")]


def test_current_status_mixed_fraction(spark):
    ledger = spark.createDataFrame([
        ("a_1", "a", "x.json", "UPLOADING", "", "2024-01-01 10:00:00"),
        ("a_2", "a", "x.json", "UPLOADED", "k", "2024-01-01 10:00:00.500000"),
    ], "file_id string, original_file_id string, file_name string, status string, "
       "s3_path string, updated_at string")
    assert landing.current_status(ledger).collect()[0].status == "UPLOADED"


def test_list_files(spark, scratch):
    os.makedirs(f"{scratch}/a/2024-01-01")
    for n in ("x.json", "y.csv"):
        with open(f"{scratch}/a/2024-01-01/{n}", "w") as f:
            f.write("12345")
    lst = landing.list_files(spark, f"{scratch}/a", "drive")
    got = sorted((r.file_name, r.length) for r in lst.collect())
    assert got == [("x.json", 5), ("y.csv", 5)]


def test_content_identity_lands_a_file_once(spark):
    # the same unchanged file offered on two run days
    day1 = _listing(spark).filter("file_ref = 'd4'")
    c1 = landing.with_content_id(landing.classify(day1, F.lit("2024-01-01").cast("date")))
    c2 = landing.with_content_id(landing.classify(day1, F.lit("2024-01-02").cast("date")))
    store_dated = c1.select(F.col("landing_key").alias("key"))
    store_content = c1.select(F.col("content_id").alias("key"))
    dated = landing.mark_existing(c2, store_dated).collect()[0]
    content = landing.mark_existing(c2, store_content, key="content_id").collect()[0]
    assert dated.already_exists is False        # dated key: landed again under the new day
    assert content.already_exists is True       # content identity: recognised
