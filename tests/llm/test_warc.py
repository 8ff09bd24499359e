import gzip
import hashlib

from pyspark.sql import functions as F

from tillroll.llm import warc

SCHEMA = "page_id long, url string, html string, key string, digest string, file string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def expected(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(data) if i is not None and len(data) >= 100 and first[data] < i else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


ROWS = [(3, "http://www.example.com/a?b=1#c", "x" * 200), (1, "https://Example.com/", "x" * 200), (2, None, None),
        (4, "no scheme", ""), (5, "http://a.b/\r\nEvil: 1", "é" * 60), (6, "http://a.b/", "é" * 60), (7, "http://s/", "y" * 99),
        (8, "http://s/", "y" * 99), (9, "http://long/", "<p>" * 400_000), (3, "http://www.example.com/a?b=1#c", "x" * 200),
        (None, "http://n/", "x" * 200), (1, "https://Example.com/", "x" * 200)]


def test_round_trip(spark):
    got = warc.archived(pages(spark, ROWS)).collect()
    assert sorted(map(tuple, got), key=str) == expected(ROWS)


def test_reading_back_is_spread_by_the_archives_bytes(spark, monkeypatch):
    import os
    rows = [(i, f"http://h{i}.example.com/", os.urandom(2000).hex()) for i in range(200)]
    files = warc.write_index(warc.write_archives(pages(spark, rows)))
    assert warc.reading_tasks(files) == 1
    monkeypatch.setattr(warc, "TASK_BYTES", 40_000)
    tasks = warc.reading_tasks(files)
    assert tasks == -(-files.agg(F.sum("bytes")).first()[0] // 40_000) > 8
    back = warc.read_records(warc.scan_index(files), tasks)
    assert back.select(F.spark_partition_id().alias("p"), "page_id").groupBy("p").count().count() > 4
    assert sorted(map(tuple, back.drop("payload", "url").collect()), key=str) == expected(rows)
    monkeypatch.setattr(warc, "MOST_TASKS", 3)
    assert warc.reading_tasks(files) == 3


def test_empty(spark):
    assert warc.archived(pages(spark, [])).collect() == []
    none = warc.write_index(warc.write_archives(pages(spark, [])))
    assert warc.lookup(none, spark.createDataFrame([("http://a/",)], "url string")).collect() == []


def test_lookup_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", 7)
    rows = [(i, f"http://h{i % 13}.example.com/p{i // 4}", f"{i} " * 50) for i in range(400)]
    files = warc.write_index(warc.write_archives(pages(spark, rows)))
    wanted = [rows[i][1] for i in (0, 5, 399, 200)] + ["http://none.example.com/", "zzz"]
    found = warc.lookup(files, spark.createDataFrame([(u,) for u in wanted], "url string"))
    assert sorted(r["page_id"] for r in found.collect()) == sorted(i for i, u, _ in rows if u in wanted)
    records = warc.read_records(found.drop("url"))
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in records.collect()} == {
        i: h for i, u, h in rows if u in wanted}
    low, high = "com,example,h3)", "com,example,h3)~"
    part = warc.scan_index(files, low, high).collect()
    assert sorted(r["page_id"] for r in part) == [i for i in range(400) if i % 13 == 3]
    keys = [r["key"] for r in warc.scan_index(files).collect()]
    assert len(keys) == 400


def test_archives_are_plain_gzip_members(spark):
    captures = warc.write_archives(pages(spark, ROWS[:5])).orderBy("file", "offset").collect()
    uri = captures[0]["file"].removeprefix("file://").removeprefix("file:")
    with gzip.open(uri) as f:
        text = f.read()
    here = [c for c in captures if c["file"] == captures[0]["file"]]
    assert text.count(b"WARC/1.1\r\n") == len(here)
    assert b"\r\nEvil" not in text


def test_keys(spark):
    df = spark.createDataFrame([("http://www.Example.com/a?b#c",), (None,), ("plain",)], "url string")
    assert [r[0] for r in df.select(warc.capture_key(F.col("url"))).collect()] == ["com,example,www)/a?b", "", "plain"]
