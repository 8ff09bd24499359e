"""Cutting JSON files by byte ranges of any size, and loads that lose nothing."""
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tillroll.plans import silver
from tillroll.sources import json_events as je
from tillroll.sources import readers
from tillroll.streaming import commit, pipes


def _event(rng, i):
    texts = ['a"b', "c\\", "[{,]}", "\\\"", "é≠", "", "x" * rng.randrange(40), "\\\\" * rng.randrange(4)]
    return {"event_id": f"e{i}", rng.choice(texts) + "k": rng.choice(texts), "n": [1, [2, {"q": rng.choice(texts)}]], "t": {}}


def _pieces(data, size):
    """Events of a file cut into ranges, as the job does it."""
    import io
    f = io.BytesIO(data)
    n = len(data)
    in_text, depth, out = False, 0, []
    for lo in range(0, n, size):
        hi = min(lo + size, n)
        out += list(je.range_events(f, n, lo, hi, in_text, depth))
        odd, closed, opened = je.range_state(f, lo, hi)
        depth += opened if in_text else closed
        in_text ^= bool(odd)
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 10_000])
def test_ranges_of_any_size_give_each_event_once(size):
    rng = random.Random(size)
    events = [_event(rng, i) for i in range(40)]
    for text in (json.dumps(events), json.dumps(events, indent=3, ensure_ascii=False), "﻿ " + json.dumps(events) + "\n",
                 "\n".join(json.dumps(e) for e in events), "".join(json.dumps(e, indent=1) for e in events)):
        got = _pieces(text.encode(), size)
        assert [g[1] for g in got] == [None] * 40
        assert [json.loads(g[0]) for g in got] == events
        assert all(text.encode()[g[2]:].lstrip(je.BLANK).removeprefix(b"\xef\xbb\xbf").lstrip(je.BLANK).startswith(g[0]) for g in got)


@pytest.mark.parametrize("size", [1, 5, 1000])
def test_what_is_no_whole_event_is_a_faulty_record(size):
    def faults(text):
        return [(g[0].decode(), g[1]) for g in _pieces(text.encode(), size)]

    assert faults("") == faults(" \n") == faults("[]") == faults(" [ ] ") == []
    assert faults('[{"a":1}') == [('{"a":1}', "unterminated")]
    assert faults('[{"a":1},{"b":') == [('{"a":1}', None), ('{"b":', "unterminated")]
    assert faults('[{"a":1}] tail') == [('{"a":1}', None), ("tail", "unterminated")]
    assert faults('[{"a":1}] x [2]') == [('{"a":1}', None), ("x", "outside_array"), ("2", None)]
    assert faults('{"a":1} {"b') == [('{"a":1}', None), ('{"b', "unterminated")]
    assert faults("plain") == [("plain", "unterminated")]
    assert faults('[1,"x",null,{"a":{}}]') == [("1", None), ('"x"', None), ("null", None), ('{"a":{}}', None)]


def test_an_event_longer_than_the_bound_comes_in_faulty_pieces():
    import io
    text = json.dumps([{"a": "y" * (5 << 20)}, {"b": 1}]).encode()
    got = list(je.range_events(io.BytesIO(text), len(text), 0, 100, False, 0, most=1 << 20))
    assert {g[1] for g in got} <= {"too_long", "unterminated", None} and got[0][1] == "too_long"
    assert b"".join(g[0] for g in got) == text[1:text.rindex(b", ")]


MIXED = ['{"event_id":"a","readings":[{"value":"n/a","unit":"kg"}],"extra":{"x":[1]}}',
         '{"event_id":"b","metadata":{"battery_pct":81.5},"readings":[{"value":2,"unit":"kg","calib":7}]}',
         '{"event_id":"c","readings":"none"}', '{"event_id":"d","readings":[{"value":1.25}]}', '{"event_id": }', "17"]


def _load(spark, folder, layout, range_bytes):
    good, bad = readers.split_json(readers.read_json_records(spark, folder, layout, range_bytes))
    got = {r.e: json.loads(r.j) for r in good.select(F.try_variant_get("raw_payload", "$.event_id", "string").alias("e"),
                                                     F.to_json("raw_payload").alias("j")).collect()}
    return good, got, sorted((r.reason, r.record) for r in bad.collect())


@pytest.mark.parametrize("layout,range_bytes", [("array", 11), ("array", 1 << 20), ("lines", 1)])
def test_ill_typed_values_and_unknown_fields_survive(spark, scratch, layout, range_bytes):
    with open(f"{scratch}/a.json", "w") as f:
        f.write("[" + ",\n".join(MIXED) + "]" if layout == "array" else "\n".join(MIXED))
    good, got, bad = _load(spark, scratch, layout, range_bytes)
    assert got == {k: json.loads(t) for k, t in zip("abcd", MIXED, strict=False)}
    assert bad == [("malformed_json", '{"event_id": }'), ("not_an_object", "17")]
    flat = {(r.event_id, r.sensor_value, r.battery_pct) for r in silver.flatten_iot(spark, good).collect()}
    assert flat == {("a", None, None), ("b", 2.0, 82), ("d", 1.25, None)}


def test_bytes_that_are_no_utf8_are_quarantined(spark, scratch):
    with open(f"{scratch}/a.json", "wb") as f:
        f.write(b'[{"event_id":"a"},{"event_id":"\xff"}]')
    _, got, bad = _load(spark, scratch, "array", 1 << 20)
    assert list(got) == ["a"] and bad == [("bad_encoding", '{"event_id":"\\xff"}')]


def _ids(spark, folder):
    return sorted(r[0] for r in spark.read.parquet(folder).select(
        F.try_variant_get("raw_payload", "$.event_id", "string")).collect())


def test_pipe_commits_both_outputs_once(spark, scratch, monkeypatch):
    src, bronze, held = f"{scratch}/json", f"{scratch}/bronze", f"{scratch}/held"
    os.makedirs(src)

    def run():
        for q in pipes.json_pipe(spark, src, bronze, f"{scratch}/ck", quarantine=held):
            q.awaitTermination()

    with open(f"{src}/a.json", "w") as f:
        f.write("[" + ",".join(MIXED) + "]")
    # the driver dies between the two outputs: the good side is shown, the other only staged
    whole = commit.publish
    monkeypatch.setattr(commit, "publish", lambda s, root, b: whole(s, root, b) if root == bronze else 1 / 0)
    with pytest.raises(Exception, match="division"):
        run()
    files = sorted(os.listdir(bronze))
    assert _ids(spark, bronze) == ["a", "b", "c", "d"] and not [x for x in os.listdir(held) if x.startswith("ingest")]
    monkeypatch.setattr(commit, "publish", whole)
    run()
    run()
    assert _ids(spark, bronze) == ["a", "b", "c", "d"] and sorted(os.listdir(bronze)) == files
    assert sorted(r.reason for r in spark.read.parquet(held).collect()) == ["malformed_json", "not_an_object"]
    with open(f"{src}/b.json", "w") as f:
        f.write('[{"event_id":"z"}]')
    run()
    assert _ids(spark, bronze) == ["a", "b", "c", "d", "z"]
    assert [tuple(r) for r in commit.load_figures(spark, bronze).orderBy("batch_id").collect()] == [(0, 4), (1, 1)]
    assert [tuple(r) for r in commit.load_figures(spark, held).orderBy("batch_id").collect()] == [(0, 2), (1, 0)]


def test_a_replay_moves_what_a_broken_commit_left(spark, scratch):
    root = f"{scratch}/out"
    rows = spark.range(40).selectExpr("id", "id % 4 as p")
    commit.stage(rows, root, 3, ("p",))
    staged = f"{root}/_staging/batch-000000000003/p=1"
    os.makedirs(f"{root}/p=1")
    name = next(x for x in os.listdir(staged) if x.startswith("part"))
    os.rename(f"{staged}/{name}", f"{root}/p=1/{name}")                     # one file had moved already
    commit.commit({root: spark.range(0).selectExpr("id", "id % 4 as p")}, 3, ("p",))
    assert spark.read.parquet(root).count() == 40
    commit.commit({root: rows}, 3, ("p",))                                    # a replay after the end
    assert spark.read.parquet(root).count() == 40
    assert commit.load_figures(spark, root).collect()[0].rows == 40
