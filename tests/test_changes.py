"""Change data: diff, as-of states, restore, conditional update (fixtures)."""
import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from tillroll.operators import changes

T = dt.datetime


def test_snapshot_diff_cases(spark):
    old = spark.createDataFrame(
        [("a", 1, "x"), ("b", 2, None), ("c", 3, "z"), ("d", None, "w"), (None, 9, "n")],
        "k string, v int, s string")
    new = spark.createDataFrame(
        [("a", 1, "x"), ("b", 2, None), ("c", 4, "z"), ("d", 5, "w"), ("e", 6, "e"), (None, 9, "m")],
        "k string, v int, s string")
    out = changes.snapshot_diff(old, new, "k")
    got = rows(out.select("k", "v", "s", "change_action", "change_isupdate"))
    # columns sorted by name: change_action, change_isupdate, k, s, v
    assert got == sorted([
        ("DELETE", True, "c", "z", 3), ("INSERT", True, "c", "z", 4),
        ("DELETE", True, "d", "w", None), ("INSERT", True, "d", "w", 5),
        ("INSERT", False, "e", "e", 6),
    ], key=lambda t: tuple((x is None, str(x)) for x in t))


def test_diff_applied_to_old_gives_new(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 20), ("d", 4)], "k string, v int")
    d = changes.snapshot_diff(old, new, "k")
    deleted = d.filter("change_action = 'DELETE'").select("k", "v")
    inserted = d.filter("change_action = 'INSERT'").select("k", "v")
    applied = old.exceptAll(deleted).unionByName(inserted)
    assert rows(applied) == rows(new)


def _log(spark):
    return spark.createDataFrame([
        ("k1", T(2024, 1, 1), "INSERT", "f1", 10),
        ("k1", T(2024, 1, 2), "INSERT", "f2", 11),     # update
        ("k2", T(2024, 1, 1), "INSERT", "f1", 20),
        ("k2", T(2024, 1, 3), "DELETE", "f3", 20),     # delete
        ("k2", T(2024, 1, 4), "INSERT", "f4", 21),     # re-insert
        ("k3", T(2024, 1, 2), "INSERT", "f2", 30),
        ("k3", T(2024, 1, 2), "INSERT", "f9", 31),     # two versions, one commit
    ], "order_id string, commit_ts timestamp_ntz, action string, source_file string, q int")


def _state(spark, log, bound, inclusive=True):
    return rows(changes.state_as_of(log, "order_id", F.lit(bound).cast("timestamp_ntz"),
                                    inclusive=inclusive, tie_cols=("source_file",)))


def test_state_as_of(spark):
    log = _log(spark)
    assert _state(spark, log, "2023-12-31 00:00:00") == []
    assert _state(spark, log, "2024-01-01 00:00:00") == [("k1", 10, "f1"), ("k2", 20, "f1")]
    assert _state(spark, log, "2024-01-03 00:00:00") == [("k1", 11, "f2"), ("k3", 31, "f9")]
    assert _state(spark, log, "2024-01-04 00:00:00") == [
        ("k1", 11, "f2"), ("k2", 21, "f4"), ("k3", 31, "f9")]
    # BEFORE the 2024-01-04 commit == AT 2024-01-03
    assert _state(spark, log, "2024-01-04 00:00:00", inclusive=False) == \
        _state(spark, log, "2024-01-03 00:00:00")


def test_as_of_offset_and_last_commit(spark):
    log = _log(spark)
    st = changes.state_as_of_offset(log, "order_id", 24 * 3600, anchor=changes.last_commit(log),
                                    tie_cols=("source_file",))
    assert rows(st) == _state(spark, log, "2024-01-03 00:00:00")


def test_restore_columns_sets_null_for_new_keys(spark):
    cur = spark.createDataFrame([("a", 5, "x"), ("b", 6, "y")], "order_id string, q int, s string")
    earlier = spark.createDataFrame([("a", 1, "old")], "order_id string, q int, s string")
    out = changes.restore_columns(cur, earlier, "order_id", ["q"])
    assert rows(out) == [("a", 1, "x"), ("b", None, "y")]


def test_update_where(spark):
    df = spark.createDataFrame([(5.0,), (None,), (12.0,)], "d double")
    out = changes.update_where(df, {"d": F.lit(99.0)}, F.col("d") < 10)
    assert [r[0] for r in out.collect()] == [99.0, None, 12.0]


def test_one_pass_forms_equal_two_pass(spark):
    log = _log(spark)
    old_b = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    new_b = changes.last_commit(log)
    st = lambda b, inc=True: changes.state_as_of(log, "order_id", b, inclusive=inc,
                                                  tie_cols=("source_file",))
    two = changes.snapshot_diff(st(old_b), st(new_b), "order_id")
    one = changes.log_diff(log, "order_id", old_b, new_b, tie_cols=("source_file",))
    assert rows(one) == rows(two) and one.count() > 0
    two = changes.restore_columns(st(new_b), st(new_b, False), "order_id", ["q"])
    one = changes.log_restore(log, "order_id", new_b, new_b, ["q"], tie_cols=("source_file",))
    assert rows(one) == rows(two)


def test_unbounded_latest_equals_last_commit_bound(spark):
    log = _log(spark)
    old_b = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    a = changes.log_diff(log, "order_id", old_b, changes.last_commit(log), tie_cols=("source_file",))
    b = changes.log_diff(log, "order_id", old_b, None, tie_cols=("source_file",))
    assert rows(a) == rows(b)


def test_rows_without_a_key_keep_their_own_identity(spark):
    from pyspark.sql import functions as F
    log = spark.createDataFrame([(None, 1, "INSERT", "x"), (None, 2, "INSERT", "y"), (None, 3, "DELETE", "z"), (1, 1, "INSERT", "a"),
                                 (1, 2, "INSERT", "b")], "id int, commit_ts int, action string, v string")
    assert sorted(str(r.v) for r in changes.state_as_of(log, "id", F.lit(3)).collect()) == ["b", "x", "y"]
    states, _ = changes.states_at(log, "id", {"c": (None, True), "e": (F.lit(1), True)})
    assert sorted(str(r.c.v) for r in states.collect() if r.c) == ["b", "x", "y"]
    assert sorted(str(r.e.v) for r in states.collect() if r.e) == ["a", "x"]
