"""Writing gold datasets (CTAS, views, the refreshed "materialized view").

* ``publish`` is ``CREATE OR REPLACE TABLE … AS SELECT``: an overwrite of a
  parquet dataset, partitioned by the report date for the daily facts.
* ``refresh_fact_days`` keeps a date-partitioned fact current without a full
  rebuild: only the report dates present in a new silver batch are
  recomputed (from all silver rows of those dates) and their partitions are
  replaced with dynamic partition overwrite.  Aggregation work is
  proportional to the touched days, not to the table.
* ``register_views`` exposes DataFrame-defined views (live, recomputed on read)
  as temporary views for SQL users.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _clustered(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Rows of one partition value together, so that a date is a file or few instead
    of one from every task; the rebalance splits days that are too large for one."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def publish(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Full replace (``CREATE OR REPLACE TABLE … AS SELECT``).  The session
    default is dynamic partition overwrite (for day refreshes), so a full
    replace asks for static mode: partitions absent from ``df`` go away."""
    w = _clustered(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def refresh_fact_days(spark: SparkSession, silver_all: DataFrame, new_batch: DataFrame,
                      build: Callable[[DataFrame], DataFrame], path: str,
                      date_col: str = "transaction_date",
                      partition_col: str = "report_date") -> None:
    """Recompute ``build(silver)`` for the dates in ``new_batch`` and replace
    just those partitions of the dataset at ``path``.

    The touched dates are a distinct projection of the batch (one row per
    day), joined back as a semi join, so no list of dates passes through the
    driver.  A NULL date is its own partition (``__HIVE_DEFAULT_PARTITION__``)."""
    days = new_batch.select(F.to_date(date_col).alias("_d")).distinct()
    touched = silver_all.join(days, F.to_date(F.col(date_col)).eqNullSafe(F.col("_d")),
                              "left_semi")
    replace_days(build(touched), path, partition_col)


def replace_days(days_only: DataFrame, path: str, partition_col: str) -> None:
    """Replace the partitions of the days that ``days_only`` holds; no other file is touched."""
    (_clustered(days_only, (partition_col,)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col).parquet(path))


def in_days(date: str | Column, days: set) -> Column:
    """A filter on dates; on a partition column it prunes folders before anything is read.
    ``days`` are calendar days, at most one per day of data; None stands for rows without one."""
    date = F.col(date) if isinstance(date, str) else date
    known = sorted(d for d in days if d is not None)
    found = date.isin(known) if known else F.lit(False)
    return found | date.isNull() if None in days else found


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
