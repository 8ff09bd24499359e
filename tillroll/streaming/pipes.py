"""Auto-ingest pipes: landed files → bronze datasets.

Each pipe is a Structured Streaming query over a folder with the file
source: every file is taken once (the offset log in the checkpoint records
which).  A micro-batch is parsed once and split into good and quarantined rows,
and both are committed under its batch id, so a replay after a lost executor or
driver does not duplicate rows and a downstream stream reading the bronze folder
sees every file once (:mod:`tillroll.streaming.commit`).  ``trigger(availableNow=True)`` back-fills what is there and
stops (the ``REFRESH`` of a pipe); ``processingTime`` keeps polling, and a
poll that finds no new file runs no batch.

Checkpoints belong under the shared folder named by ``spark.checkpoint.dir``
(see :func:`tillroll.session.state_path`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll import schemas
from tillroll.sources import json_events, readers
from tillroll.streaming.commit import MARKERS, commit, exists, make_folder


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def check_sink(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse a sink that another checkpoint has written: its batch numbers would be
    taken for ones already committed, and new files would be lost without a word."""
    written = any(exists(spark, f"{path}/{log}") for log in ("_spark_metadata", MARKERS))
    if written and not exists(spark, f"{checkpoint}/offsets"):
        raise RuntimeError(f"{path} was written with another checkpoint than {checkpoint}; "
                           "restore that one, or start with an empty folder")


INGEST_DATE = "ingest_date"


def to_committed(rows: DataFrame, outputs: Callable[[DataFrame], dict[str, DataFrame]], roots: list[str], checkpoint: str,
                 trigger: str | None = None, name: str | None = None, partition_by: tuple[str, ...] = (),
                 measures: dict | None = None) -> StreamingQuery:
    """Write what ``outputs`` makes of every micro-batch (folder → rows) under its batch id
    (:mod:`tillroll.streaming.commit`); ``roots`` are all folders that it can name.  A
    replayed batch changes nothing."""
    spark = rows.sparkSession
    for path in roots:
        check_sink(spark, path, checkpoint)
    for path in roots:
        make_folder(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read and parsed once for all outputs
        try:
            commit(outputs(batch), batch_id, partition_by, measures)
        finally:
            batch.unpersist()

    w = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(w.queryName(name) if name else w, trigger).start()


def to_bronze(rows: DataFrame, split, bronze: str, quarantine: str, checkpoint: str,
              trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """One parse, two outputs: every micro-batch is split by ``split`` into good rows
    and quarantined ones, both by load day (``ingest_date``), so a read of one load
    window prunes to its day folders."""
    def outputs(batch: DataFrame) -> dict[str, DataFrame]:
        return {root: side.withColumn(INGEST_DATE, F.to_date("loaded_time"))
                for root, side in zip((bronze, quarantine), split(batch), strict=True)}

    return to_committed(rows, outputs, [bronze, quarantine], checkpoint, trigger, name, (INGEST_DATE,))


def pos_pipe(spark: SparkSession, source: str, bronze: str, quarantine: str,
             checkpoint: str, trigger: str | None = None) -> list[StreamingQuery]:
    """CSV stage → ``stg_csv_transaction`` (good rows) and a quarantine of
    rows that cannot be staged."""
    raw = readers.read_pos_csv(spark, source, stream=True)
    return [to_bronze(raw, readers.split_pos, bronze, quarantine, checkpoint, trigger, "pos_pipe")]


def json_pipe(spark: SparkSession, source: str, bronze: str, checkpoint: str,
              layout: str = "array", trigger: str | None = None,
              quarantine: str | None = None) -> list[StreamingQuery]:
    """JSON stage → ``stg_json_iot`` (a VARIANT payload per event + lineage) and a
    quarantine (default: beside the bronze folder) of what is no event.

    ``array``: the stream carries the new files' names, and tasks cut their bytes into
    events; ``lines``: it carries the lines."""
    def load(records: DataFrame) -> tuple[DataFrame, DataFrame]:
        return readers.split_json(records.withColumn("loaded_time", F.current_timestamp()))

    if layout == "lines":
        rows, split = readers.json_lines(spark, source, stream=True), load
    else:
        rows = readers.list_json_files(spark, source, stream=True)

        def split(files: DataFrame) -> tuple[DataFrame, DataFrame]:
            return load(json_events.cut_events(files))

    return [to_bronze(rows, split, bronze, quarantine or f"{bronze}_quarantine", checkpoint, trigger, "json_pipe")]


def _parquet_pipe(spark: SparkSession, source: str, bronze: str, checkpoint: str, trigger: str | None,
                  quarantine: str | None, glob: str, schema, name: str) -> StreamingQuery:
    """The stream carries the new files' names; each batch's files are grouped by the
    layout in their footers and conformed to the declared schema."""
    def split(files: DataFrame) -> tuple[DataFrame, DataFrame]:
        return readers.load_parquet_files(files, schema)

    files = readers.list_json_files(spark, source, stream=True, glob=glob)
    return to_bronze(files, split, bronze, quarantine or f"{bronze}_quarantine", checkpoint, trigger, name)


def orders_pipe(spark: SparkSession, source: str, bronze: str, checkpoint: str,
                trigger: str | None = None, quarantine: str | None = None) -> StreamingQuery:
    """Parquet stage, files named ``*orders*.parquet`` → order log bronze, whatever the
    spelling, order and types of their columns; what does not fit is quarantined
    (default: beside the bronze folder)."""
    return _parquet_pipe(spark, source, bronze, checkpoint, trigger, quarantine, readers.ORDERS_GLOB,
                         schemas.ERP_ORDERS, "orders_pipe")


def inventory_pipe(spark: SparkSession, source: str, bronze: str, checkpoint: str,
                   trigger: str | None = None, quarantine: str | None = None) -> StreamingQuery:
    """Parquet stage, files named ``*inventory*.parquet`` → inventory bronze, as :func:`orders_pipe`."""
    return _parquet_pipe(spark, source, bronze, checkpoint, trigger, quarantine, readers.INVENTORY_GLOB,
                         schemas.ERP_INVENTORY, "inventory_pipe")
