"""Silver tasks: bronze → silver as streams (C4–C7, B3 incremental).

* POS and IoT are row-local transforms (clean, flatten): a file-source stream
  over the bronze folder → the same DataFrame function as the batch job →
  month folders, committed by batch id.  Bronze files keep their names for good, so
  each is consumed once (append-only change stream).  The days that a batch touches
  are observed while it is written; the gold refresh starts from them.
* Orders are an upsert.  ``foreachBatch`` merges each micro-batch into the
  hash buckets that its keys fall into and writes only these anew
  (:mod:`tillroll.streaming.merge`), with the batch's change rows beside them.  The
  definition form (``silver.upsert_orders`` over the whole bronze log, one
  aggregation) gives the same state.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    BooleanType, DateType, LongType, StringType, StructField, StructType, TimestampType, VariantType,
)

from tillroll import schemas
from tillroll.plans import publish, silver
from tillroll.streaming import merge
from tillroll.streaming.commit import load_figures
from tillroll.streaming.pipes import _trigger, to_committed


def bronze_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


#: Partition column of silver: the first day of the month of a row's sale or event.  Days are
#: together inside a month's files, so row-group statistics prune to them; a folder per day
#: would turn a back-fill of years into thousands of tiny files per batch.
MONTH = "month"


def _by_month(rows: DataFrame, column: str, silver_path: str) -> dict[str, DataFrame]:
    dated = rows.withColumn(MONTH, F.trunc(F.to_date(column), "MM"))
    return {silver_path: dated.hint("rebalance", MONTH).sortWithinPartitions(MONTH, column)}


def _touched(column: str) -> dict[str, Column]:
    """Observed of each silver batch: the days that it touches, for the gold refresh."""
    day = F.coalesce(F.to_date(column).cast("string"), F.lit(""))
    return {"days": F.to_json(F.collect_set(day))}


def pos_task(spark: SparkSession, bronze: str, silver_path: str, checkpoint: str,
             trigger: str | None = None) -> StreamingQuery:
    """Staged POS lines → ``silver_csv_transaction``, by month of sale."""
    def outputs(batch: DataFrame) -> dict[str, DataFrame]:
        return _by_month(silver.clean_pos(batch), "transaction_date", silver_path)

    return to_committed(bronze_stream(spark, bronze, schemas.POS_STAGING), outputs, [silver_path], checkpoint, trigger,
                        "task_csv_to_silver", (MONTH,), _touched("transaction_date"))


def iot_task(spark: SparkSession, bronze: str, silver_path: str, checkpoint: str,
             trigger: str | None = None) -> StreamingQuery:
    """VARIANT payloads → one row per reading, by month of event."""
    schema = StructType([StructField("raw_payload", VariantType()),
                         StructField("source_file", StringType()),
                         StructField("loaded_time", TimestampType())])

    def outputs(batch: DataFrame) -> dict[str, DataFrame]:
        return _by_month(silver.flatten_iot(spark, batch), "event_ts", silver_path)

    return to_committed(bronze_stream(spark, bronze, schema), outputs, [silver_path], checkpoint, trigger,
                        "task_json_to_silver", (MONTH,), _touched("event_ts"))


def read_silver(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A silver dataset with its ``month``; a filter on it prunes folders."""
    return spark.read.schema(StructType([*schema.fields, StructField(MONTH, DateType())])).parquet(path)


def only_days(rows: DataFrame, column: str, days: set) -> DataFrame:
    """Silver rows of some days (None: without a date): folders are pruned by month, then rows by day."""
    months = {d and d.replace(day=1) for d in days}
    return rows.filter(publish.in_days(MONTH, months) & publish.in_days(F.to_date(column), days))


def touched_days(spark: SparkSession, path: str, after: int) -> tuple[set, int]:
    """``(days, newest batch)`` of the batches behind ``after``, from what was observed while they
    were written; the dataset is not read.  None stands for rows without a date."""
    rows = load_figures(spark, path, "days string").where(F.col("batch_id") > after).select("batch_id", "days").collect()
    days = {dt.date.fromisoformat(d) if d else None for r in rows if r["days"] for d in json.loads(r["days"])}
    return days, max([after, *(r["batch_id"] for r in rows)])


# ---------------------------------------------------------------- upsert
def generations(spark: SparkSession, root: str) -> list[int]:
    """Committed batch ids of the orders table, ascending."""
    return merge.batches(spark, root)


def read_current(spark: SparkSession, root: str, schema=schemas.ERP_ORDERS_SILVER,
                 before: int | None = None) -> DataFrame:
    """The orders after the newest batch (optionally the newest one below ``before``)."""
    return merge.read_table(spark, root, schema, before)


def merge_batch(spark: SparkSession, root: str, batch: DataFrame, batch_id: int,
                changes: str | None = None, buckets: int = merge.BUCKETS, keep: int | None = None) -> None:
    """Apply one bronze micro-batch (MERGE: update all on match, else insert).

    Within the batch the last processed version of a key wins (same total
    order as the definition form); NULL keys never match and are inserted.  With
    ``changes`` the batch's change rows go to that folder; with ``keep`` older states go."""
    merge.merge(batch, batch_id, root, schemas.ERP_ORDERS_SILVER, silver.ORDER_KEY, silver.ORDER_SEQUENCE,
                "process_time", changes, buckets=buckets, keep=keep)


def read_changes(spark: SparkSession, path: str, after: int = -1) -> DataFrame:
    """The change rows of the batches behind ``after`` (a stream's offset); only their folders are read."""
    fields = [*schemas.ERP_ORDERS_SILVER.fields, StructField("change_action", StringType()),
              StructField("change_isupdate", BooleanType()), StructField(merge.CHANGE_BATCH, LongType())]
    return spark.read.schema(StructType(fields)).parquet(path).filter(F.col(merge.CHANGE_BATCH) > after)


def orders_task(spark: SparkSession, bronze: str, silver_root: str, checkpoint: str,
                trigger: str | None = None, changes: str | None = None) -> StreamingQuery:
    """MERGE each bronze micro-batch into ``silver_erp_orders``; C3: its change rows
    (default folder: beside the table)."""
    changes = changes or f"{silver_root}_changes"
    stream = bronze_stream(spark, bronze, schemas.ERP_ORDERS_BRONZE)
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .queryName("task_orders_to_silver")
         .foreachBatch(lambda df, bid: merge_batch(spark, silver_root, df, bid, changes)))
    return _trigger(w, trigger).start()
