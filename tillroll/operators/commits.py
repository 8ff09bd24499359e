"""A change log kept by commits: each load is one numbered commit, indexed as it is written.

A commit's rows lie in a folder of their number, and the marker that ends the
commit holds its row count and the first and last commit time in it, observed
while the rows were written.  These markers are the index: one small record a
load.  An as-of read looks its bound up there, as a scalar subquery over the
index, and the scan prunes the folders of all later commits before it opens a
file; no read of the log itself is needed to find its last commit.

A later commit wins over an earlier one; within a commit the later commit time
does, then ``tie_cols`` and the other columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import changes
from tillroll.operators.latest import latest_per_key
from tillroll.streaming import commit

NUMBER = "commit_no"


def append(root: str, rows: DataFrame, number: int, commit_col: str = "commit_ts") -> None:
    """Add ``rows`` as commit ``number``.  A number that is there already stays as it is (a replay)."""
    commit.commit({root: rows.withColumn(NUMBER, F.lit(number).cast("long"))}, number, (NUMBER,),
                  {"low": F.min(commit_col).cast("string"), "high": F.max(commit_col).cast("string")})


def index(spark: SparkSession, root: str) -> DataFrame:
    """``commit_no, rows, low, high`` of every commit (times are null if it has none), from the markers alone."""
    found = commit.load_figures(spark, root, "low string, high string")
    return found.select(F.col("batch_id").alias(NUMBER), "rows", F.col("low").cast("timestamp_ntz").alias("low"),
                        F.col("high").cast("timestamp_ntz").alias("high"))


def last_commit(spark: SparkSession, root: str) -> Column:
    """Number of the newest commit, from the index."""
    return index(spark, root).select(F.max(NUMBER)).scalar()


def last_time(spark: SparkSession, root: str) -> Column:
    """The newest commit time, from the index: an anchor for offsets that reads no row of the log."""
    return index(spark, root).select(F.max("high")).scalar()


def _log(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all commits; those of a commit that is not ended are not among them."""
    return spark.read.option("basePath", root).parquet(root).withColumn(NUMBER, F.col(NUMBER).cast("long"))


def latest_state(rows: DataFrame, key, commit_col: str = "commit_ts", tie_cols: Sequence[str] = (),
                 action_col: str = "action") -> DataFrame:
    """For each key its last version, unless that deletes it.  Rows without a key that are no deletes all stay."""
    keys = [key] if isinstance(key, str) else list(key)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    payload = [c for c in rows.columns if c not in (*keys, NUMBER, commit_col, action_col)]
    last = latest_per_key(rows.where(known), keys, [NUMBER, commit_col, *tie_cols, action_col])
    return last.unionByName(rows.where(~known)).where(F.col(action_col) != changes.ACTION_DELETE).select(*keys, *payload)


def _pruned(spark: SparkSession, root: str, bound: Column, inclusive: bool) -> DataFrame:
    log = _log(spark, root)
    return log.where(F.col(NUMBER) <= bound if inclusive else F.col(NUMBER) < bound)


def state_at_commit(spark: SparkSession, root: str, key, number: Column, *, inclusive: bool = True,
                    commit_col: str = "commit_ts", tie_cols: Sequence[str] = ()) -> DataFrame:
    """The table after commit ``number``; before it with ``inclusive=False`` (``BEFORE(STATEMENT => …)``)."""
    return latest_state(_pruned(spark, root, number, inclusive), key, commit_col, tie_cols)


def state_at_time(spark: SparkSession, root: str, key, time: Column, *, commit_col: str = "commit_ts",
                  tie_cols: Sequence[str] = ()) -> DataFrame:
    """``AT(TIMESTAMP => time)``: folders after the last commit that holds such a time are not read."""
    upto = index(spark, root).where(F.col("low") <= time).select(F.max(NUMBER)).scalar()
    rows = _pruned(spark, root, upto, True).where(F.col(commit_col) <= time)
    return latest_state(rows, key, commit_col, tie_cols)
