"""What became of each landed file, from what the loads themselves left behind.

Every bronze and quarantined row carries its ``source_file`` and ``loaded_time``.
Counted per file and joined to the listing of the landing folder, they tell of
each file whether it was loaded, how many of its rows were, and when: a status
that no step has to write down, and that cannot disagree with the tables.

The counts combine map-side, so a file that holds a third of all rows sends one
row per task; what is joined has one row per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.sources import landing

R = F.col

LOADED, PARTLY_LOADED, QUARANTINED = "LOADED", "PARTLY_LOADED", "QUARANTINED"
NO_ROWS = "NO_ROWS"          # offered, accepted, and no row of it anywhere: blank, or not loaded yet


def landed_files(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Listing of a landing folder, with both spellings under which readers name a file
    (``file_ref`` as in its path, ``file_uri`` with escapes).  No content is read.  Files of no bytes
    are in no listing that Spark makes, here and in the pipes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.lit(feed).alias("feed"), R("path").alias("file_ref"), R("_metadata.file_path").alias("file_uri"),
        F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"), "length",
        R("modificationTime").cast("timestamp_ntz").alias("modified_at"))


def _counted(tables: Sequence[DataFrame], name: str) -> DataFrame:
    """Rows and last load time per ``source_file`` over bronze tables or quarantines."""
    rows = None
    for t in tables:
        t = t.select("source_file", R("loaded_time").cast("timestamp_ntz").alias("loaded_time"))
        rows = t if rows is None else rows.unionByName(t)
    found = rows.groupBy("source_file").agg(F.count(F.lit(1)).alias(name), F.max("loaded_time").alias("loaded_time"))
    return found.withColumn("rows_quarantined" if name == "rows_loaded" else "rows_loaded", F.lit(0).cast("long"))


def file_outcomes(files: DataFrame, bronze: Sequence[DataFrame], quarantine: Sequence[DataFrame]) -> DataFrame:
    """Per landed file: ``feed, file_ref, file_name, modified_at, status, rows_loaded, rows_quarantined,
    loaded_time``.

    ``status`` is the feed's ``SKIPPED_*`` for an extension that it does not take and that left no
    rows, else what its rows say.  A file that a table names and that is no longer in the
    landing folder is reported too, without a feed and time of arrival."""
    counts = _counted(bronze, "rows_loaded").unionByName(_counted(quarantine, "rows_quarantined"))
    counts = counts.groupBy("source_file").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_quarantined").alias("rows_quarantined"),
        F.max("loaded_time").alias("loaded_time"))
    gate = landing.classify(files, F.to_date("modified_at")).select(
        "feed", "file_ref", "file_name", "modified_at", "skip_status",
        F.explode(F.array_distinct(F.array("file_ref", "file_uri"))).alias("named"))
    both = gate.join(counts, R("named") == R("source_file"), "full_outer")
    # a file has one row for each spelling, of which the tables use one, or two in turn
    ref = F.coalesce("file_ref", "source_file")
    per = both.groupBy(ref.alias("file_ref")).agg(
        F.max("feed").alias("feed"), F.max("file_name").alias("file_name"), F.max("modified_at").alias("modified_at"),
        F.max("skip_status").alias("skip_status"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("long").alias("rows_loaded"),
        F.coalesce(F.sum("rows_quarantined"), F.lit(0)).cast("long").alias("rows_quarantined"),
        F.max("loaded_time").alias("loaded_time"))
    good, bad = R("rows_loaded") > 0, R("rows_quarantined") > 0
    status = (F.when(good & bad, PARTLY_LOADED).when(good, LOADED).when(bad, QUARANTINED)
              .otherwise(F.coalesce("skip_status", F.lit(NO_ROWS))))
    name = F.coalesce("file_name", F.regexp_extract("file_ref", r"([^/]*)$", 1))
    return per.select("feed", "file_ref", name.alias("file_name"), "modified_at", status.alias("status"),
                      "rows_loaded", "rows_quarantined", "loaded_time")


def outcome_events(outcomes: DataFrame) -> DataFrame:
    """The ledger (``schemas.LEDGER``) of what happened to the files: its arrival at its own
    modification time (``UPLOADED``, or the ``SKIPPED_*`` that ended it there) and the end of its
    load at the load's time.  Only events that left a trace are listed; ``landing.current_status`` and
    ``landing.latest_events`` read it like any ledger."""
    skipped = R("status").startswith("SKIPPED")
    arrived = F.when(R("modified_at").isNotNull(), F.struct(
        F.when(skipped, R("status")).otherwise(schemas.STATUS_UPLOADED).alias("status"), R("modified_at").alias("at")))
    ended = F.when(R("loaded_time").isNotNull(), F.struct(R("status"), R("loaded_time").alias("at")))
    events = outcomes.select("file_ref", "file_name", F.inline(F.array_compact(F.array(arrived, ended))))
    return events.select(
        F.concat("file_ref", F.lit("_"), landing._epoch_text(R("at"))).alias("file_id"),
        R("file_ref").alias("original_file_id"), "file_name", "status",
        F.when(R("status").startswith("SKIPPED"), "").otherwise(R("file_ref")).alias("s3_path"),
        landing._updated_at_text(R("at")).alias("updated_at"))
