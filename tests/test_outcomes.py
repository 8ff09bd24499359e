"""What became of landed files, read off the tables; the ledger made of it."""
import json
import os

from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.sources import landing
from tillroll.streaming import outcomes, pipes


def _event(i):
    return {"event_id": str(i), "event_type": "x", "store_id": "1", "readings": []}


def _land(scratch):
    src = f"{scratch}/json/2024-01-01"
    os.makedirs(src)
    texts = {
        "good.json": json.dumps([_event(1), _event(2)]),
        "with space.json": json.dumps([_event(3)]),        # readers escape its name, or do not
        "plus+100%.json": json.dumps([_event(4), 7]),      # an element that is no event
        "broken.json": "this is no json",
        "blank.json": "\n",
    }
    for name, text in texts.items():
        with open(f"{src}/{name}", "w") as f:
            f.write(text)
    return f"{scratch}/json"


def _tables(spark, scratch, src, layout):
    bronze, held = f"{scratch}/bronze-{layout}", f"{scratch}/held-{layout}"
    for q in pipes.json_pipe(spark, src, bronze, f"{scratch}/state-{layout}", layout, quarantine=held):
        q.awaitTermination()
    good = spark.read.schema("raw_payload variant, source_file string, loaded_time timestamp").parquet(bronze)
    return good, spark.read.schema("record string, source_file string, loaded_time timestamp").parquet(held)


def test_outcomes_are_those_of_the_tables(spark, scratch):
    src = _land(scratch)
    files = outcomes.landed_files(spark, src, landing.FEED_DRIVE)
    good, bad = _tables(spark, scratch, src, "array")
    found = outcomes.file_outcomes(files, [good], [bad])
    got = {r.file_name: (r.status, r.rows_loaded, r.rows_quarantined) for r in found.collect()}
    assert got.pop("broken.json")[:2] == ("QUARANTINED", 0)
    assert got == {"good.json": ("LOADED", 2, 0), "with space.json": ("LOADED", 1, 0),
                   "plus+100%.json": ("PARTLY_LOADED", 1, 1), "blank.json": ("NO_ROWS", 0, 0)}
    # the counts add up to the tables
    total = found.agg(F.sum("rows_loaded"), F.sum("rows_quarantined")).first()
    assert tuple(total) == (good.count(), bad.count())
    assert all(r.loaded_time is not None and r.feed == "drive" for r in found.where("status <> 'NO_ROWS'").collect())
    # the other layout names files with escapes
    got = {r.file_name: r.status for r in outcomes.file_outcomes(files, *([t] for t in _tables(spark, scratch, src, "lines"))).collect()}
    assert len(got) == 5 and got["broken.json"] == "QUARANTINED" and got["blank.json"] == "NO_ROWS"


def test_ledger_of_outcomes(spark, scratch):
    src = _land(scratch)
    with open(f"{src}/2024-01-01/notes.xlsx", "w") as f:
        f.write("x")
    os.utime(f"{src}/2024-01-01/good.json", (1_700_000_000, 1_700_000_000))
    files = outcomes.landed_files(spark, src, landing.FEED_DRIVE)
    good, bad = _tables(spark, scratch, src, "array")
    # the spreadsheet is offered but never taken in
    mine = ~F.col("source_file").endswith("xlsx")
    found = outcomes.file_outcomes(files, [good.where(mine)], [bad.where(mine)])
    ledger = outcomes.outcome_events(found)
    assert ledger.columns == [f.name for f in schemas.LEDGER.fields]
    events = {}
    for r in ledger.orderBy("updated_at").collect():
        events.setdefault(r.file_name, []).append(r.status)
    assert events["good.json"] == ["UPLOADED", "LOADED"] and events["notes.xlsx"] == ["SKIPPED_NOT_JSON"]
    assert events["blank.json"] == ["UPLOADED"] and events["broken.json"] == ["UPLOADED", "QUARANTINED"]
    assert ledger.where("file_name = 'good.json' AND status = 'UPLOADED'").first().updated_at == "2023-11-14 22:13:20"
    now = {r.file_name: r.status for r in landing.current_status(ledger).collect()}
    assert now == {k: v[-1] for k, v in events.items()}
    assert len(landing.latest_events(ledger, 3).collect()) == 3


def test_files_that_left_and_empty_tables(spark, scratch):
    os.makedirs(f"{scratch}/json")
    none = spark.createDataFrame([], "feed string, file_ref string, file_uri string, file_name string, length long, modified_at timestamp_ntz")
    table = spark.createDataFrame([("file:///gone/a.json",)] * 3, "source_file string").withColumn("loaded_time", F.current_timestamp())
    got = outcomes.file_outcomes(none, [table], [table.limit(0)]).collect()
    assert [(r.feed, r.file_name, r.status, r.rows_loaded) for r in got] == [(None, "a.json", "LOADED", 3)]
    assert outcomes.outcome_events(outcomes.file_outcomes(none, [table], [table.limit(0)])).select("status").collect() == [("LOADED",)]
    assert outcomes.file_outcomes(none, [table.limit(0)], [table.limit(0)]).collect() == []
