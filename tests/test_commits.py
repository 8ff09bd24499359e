"""The change log kept by commits: equals the as-of states of the plain log, prunes, replays."""
import datetime as dt
import random

from pyspark.sql import functions as F

from helpers import rows
from tillroll.operators import changes, commits

SCHEMA = "order_id string, commit_ts timestamp_ntz, action string, source_file string, q int"


def _loads(seed=5, n=4):
    """Loads in order of time; some keys deleted, some null."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        out.append([(rng.choice(["a", "b", "c", "d", "e", None]), dt.datetime(2024, 1 + i, rng.randint(1, 28)),
                     rng.choice(["INSERT", "INSERT", "DELETE"]), f"f{i}-{j}", rng.randrange(100)) for j in range(8)])
    return out


def _root(spark, tmp_path, loads):
    root = str(tmp_path / "log")
    for i, load in enumerate(loads):
        commits.append(root, spark.createDataFrame(load, SCHEMA), i)
    return root


def test_states_equal_the_plain_log(spark, tmp_path):
    loads = _loads()
    root = _root(spark, tmp_path, loads)
    for n in range(len(loads)):
        plain = spark.createDataFrame([r for load in loads[:n + 1] for r in load], SCHEMA)
        want = rows(changes.state_as_of(plain, "order_id", F.lit("2030-01-01").cast("timestamp_ntz"), tie_cols=("source_file",)))
        assert rows(commits.state_at_commit(spark, root, "order_id", F.lit(n), tie_cols=("source_file",))) == want
        assert rows(commits.state_at_commit(spark, root, "order_id", F.lit(n + 1), inclusive=False, tie_cols=("source_file",))) == want
    log = spark.createDataFrame([r for load in loads for r in load], SCHEMA)
    for when in ("2023-12-31", "2024-02-14 00:00:00", "2024-04-30"):
        bound = F.lit(when).cast("timestamp_ntz")
        assert rows(commits.state_at_time(spark, root, "order_id", bound, tie_cols=("source_file",))) == rows(
            changes.state_as_of(log, "order_id", bound, tie_cols=("source_file",)))
    assert commits.state_at_commit(spark, root, "order_id", F.lit(0), inclusive=False).collect() == []


def test_index_replay_and_empty_load(spark, tmp_path):
    loads = _loads()
    root = _root(spark, tmp_path, loads)
    commits.append(root, spark.createDataFrame(loads[0], SCHEMA), 2)      # a replay: number 2 is there
    commits.append(root, spark.createDataFrame([], SCHEMA), 4)
    times = [[r[1] for r in load] for load in loads]
    assert [tuple(r) for r in commits.index(spark, root).orderBy("commit_no").collect()] == [
        *((i, 8, min(t), max(t)) for i, t in enumerate(times)), (4, 0, None, None)]
    last = spark.range(1).select(commits.last_commit(spark, root).alias("n"), commits.last_time(spark, root).alias("t")).first()
    assert (last["n"], last["t"]) == (4, max(times[-1]))


def test_a_later_commit_wins_over_a_later_time(spark, tmp_path):
    root = _root(spark, tmp_path, [[("a", dt.datetime(2024, 5, 1), "INSERT", "x", 1)], [("a", dt.datetime(2024, 4, 1), "INSERT", "y", 2)]])
    assert rows(commits.state_at_commit(spark, root, "order_id", F.lit(1))) == [("a", 2, "y")]
    # a load with earlier times than its number suggests is still read
    assert rows(commits.state_at_time(spark, root, "order_id", F.lit("2024-04-15").cast("timestamp_ntz"))) == [("a", 2, "y")]


def test_folders_of_later_commits_are_not_read(spark, tmp_path):
    root = _root(spark, tmp_path, _loads())
    state = commits.state_at_commit(spark, root, "order_id", commits.last_commit(spark, root), inclusive=False)
    plan = state._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert filters and all("PartitionFilters: [isnotnull(commit_no" in f and "ubquery" in f.split("PartitionFilters")[1].split("PushedFilters")[0]
                           for f in filters), filters
    # only files that a pruned scan leaves alone may be broken
    broken = next((tmp_path / "log" / "commit_no=3").glob("*.parquet"))
    broken.write_bytes(b"PAR1 not a parquet file PAR1")
    for crc in broken.parent.glob(".*.crc"):
        crc.unlink()
    assert state.count() >= 0 and len(rows(state)) > 0
