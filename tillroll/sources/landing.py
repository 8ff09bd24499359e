"""Landing decisions and the status ledger, as DataFrame jobs over a listing.

A *listing* has one row per offered file: ``feed, file_ref, file_name,
length, modified_at`` (from ``list_files`` over a folder, or derived from
data).  A run:

1. classifies each file by lower-cased extension against the feed's accepted
   set (rejects get ``SKIPPED_NOT_JSON`` / ``SKIPPED_INVALID_FILE``);
2. builds the dated landing key ``json/{day}/{name}`` or
   ``ftp/{ext}/{day}/{name}``;
3. skips files whose key is already in the store (``ALREADY_EXISTS``) with an
   anti/semi join against the store's key listing (a shuffle on the key,
   never a driver-side lookup per file);
4. appends status events: (DOWNLOADING, Drive only) → UPLOADING → UPLOADED →
   DELETED, one row per event, never updated in place.

The ledger's current view (latest event per file) and the newest-k events
are aggregates over the append-only ledger.  Moving the bytes (object-store
upload, remote API download) is outside Spark and not done here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions.expr import file_extension, file_identity

# Feeds, accepted extensions, rejection statuses, key prefixes.
FEED_DRIVE = "drive"
FEED_FTP = "ftp"
ACCEPTED = {FEED_DRIVE: [".json"], FEED_FTP: [".csv", ".parquet"]}
REJECT_STATUS = {FEED_DRIVE: schemas.STATUS_SKIPPED_NOT_JSON,
                 FEED_FTP: schemas.STATUS_SKIPPED_INVALID_FILE}
# Event sequence of an accepted, new file per feed (status, carries the key).
UPLOAD_SEQUENCE = {
    FEED_DRIVE: [(schemas.STATUS_DOWNLOADING, False), (schemas.STATUS_UPLOADING, False),
                 (schemas.STATUS_UPLOADED, True), (schemas.STATUS_DELETED, True)],
    FEED_FTP: [(schemas.STATUS_UPLOADING, False), (schemas.STATUS_UPLOADED, True),
               (schemas.STATUS_DELETED, True)],
}

R = F.col


def list_files(spark: SparkSession, path: str, feed: str, glob: str | None = None) -> DataFrame:
    """S11 listing of a folder: name, size, modification time (no content is
    read; ``binaryFile`` with ``content`` pruned lists in parallel)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path).select("path", "length", "modificationTime")
    return df.select(F.lit(feed).alias("feed"), R("path").alias("file_ref"),
                     F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"),
                     "length", R("modificationTime").cast("timestamp_ntz").alias("modified_at"))


def _feed_case(feed: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(feed == k, v) if out is None else out.when(feed == k, v)
    return out


def classify(listing: DataFrame, run_day: Column) -> DataFrame:
    """Extension, accepted flag, rejection status, dated landing key.

    ``run_day`` is the processing date (a column, e.g. ``current_date()`` or
    a per-file day)."""
    ext = file_extension(R("file_name"))
    accepted = _feed_case(R("feed"), {k: ext.isin(v) for k, v in ACCEPTED.items()})
    day = F.date_format(run_day, "yyyy-MM-dd")
    key = _feed_case(R("feed"), {
        # strict: without a day there is no key
        FEED_DRIVE: F.concat(F.lit("json/"), day, F.lit("/"), R("file_name")),
        FEED_FTP: F.concat(F.lit("ftp/"), F.regexp_replace(ext, r"\.", ""), F.lit("/"), day,
                           F.lit("/"), R("file_name")),
    })
    return listing.select(
        "*", ext.alias("extension"), accepted.alias("accepted"),
        F.when(~accepted, _feed_case(R("feed"), {k: F.lit(v) for k, v in REJECT_STATUS.items()}))
         .alias("skip_status"),
        F.when(accepted, key).alias("landing_key"))


def with_content_id(listing: DataFrame) -> DataFrame:
    """Content identity of an offered file: md5 of (name, length, modified
    time).  Keying the existence check on it lands an unchanged file once,
    whatever day it is offered again; the dated ``landing_key`` (the default)
    lands it again under each new day's folder."""
    return listing.withColumn("content_id", file_identity("file_name", "length", "modified_at"))


def mark_existing(classified: DataFrame, store_keys: DataFrame, key: str = "landing_key",
                  store_key: str = "key") -> DataFrame:
    """Flag accepted files whose key is already in the store.

    A left join on the key against the *distinct* store keys (so a file row
    cannot fan out); the store listing may be any size, the join shuffles on
    the key or broadcasts it when AQE measures it small.  Files without a key
    (rejected ones) stay out of the join: all of them would meet in one task."""
    keys = store_keys.select(R(store_key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    keyed = classified.filter(R(key).isNotNull())
    j = keyed.join(keys, keyed[key] == R("_k"), "left")
    j = j.select(*[keyed[c] for c in classified.columns],
                 F.coalesce(R("_hit"), F.lit(False)).alias("already_exists"))
    return j.unionByName(classified.filter(R(key).isNull()).withColumn("already_exists", F.lit(False)))


def _updated_at_text(ts: Column) -> Column:
    """``str(datetime)``: fraction only when the microseconds are non-zero."""
    whole = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    micros = F.unix_micros(ts.cast("timestamp")) % 1_000_000
    return F.when(micros == 0, whole).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _epoch_text(ts: Column) -> Column:
    """Seconds since the epoch, a point and always six digits of microseconds."""
    us = F.unix_micros(ts.cast("timestamp"))
    secs = F.floor(us / 1_000_000).cast("bigint")
    frac = us - secs * 1_000_000
    return F.concat(secs.cast("string"), F.lit("."), F.lpad(frac.cast("string"), 6, "0"))


def status_events(marked: DataFrame, run_ts: Column, step_seconds: int = 1) -> DataFrame:
    """The ledger rows a run appends for each listed file.

    Rejected → one ``SKIPPED_*`` event; existing → ``ALREADY_EXISTS`` (with
    key); new → the feed's upload sequence.  Event *i* of a file is stamped
    ``run_ts + i·step``; ``file_id`` = ``{original}_{epoch}``.  Map-only: each
    file expands to at most four rows."""
    def ev(status, with_key, i):
        return F.struct(F.lit(status).alias("status"),
                        (F.when(F.lit(with_key), R("landing_key")).otherwise(F.lit(""))).alias("s3_path"),
                        F.lit(i).alias("i"))

    seq = {feed: F.array(*[ev(s, k, i) for i, (s, k) in enumerate(steps)])
           for feed, steps in UPLOAD_SEQUENCE.items()}
    events = (F.when(~R("accepted"), F.array(F.struct(R("skip_status").alias("status"),
                                                       F.lit("").alias("s3_path"),
                                                       F.lit(0).alias("i"))))
               .when(R("already_exists"), F.array(F.struct(
                   F.lit(schemas.STATUS_ALREADY_EXISTS).alias("status"),
                   R("landing_key").alias("s3_path"), F.lit(0).alias("i"))))
               .otherwise(_feed_case(R("feed"), seq)))
    x = marked.select("file_ref", "file_name", run_ts.cast("timestamp_ntz").alias("_run_ts"),
                      F.inline(events))
    ts = R("_run_ts") + F.make_dt_interval(secs=(R("i") * step_seconds).cast("decimal(18,6)"))
    return x.select(
        F.concat(R("file_ref"), F.lit("_"), _epoch_text(ts)).alias("file_id"),
        R("file_ref").alias("original_file_id"), "file_name", "status", "s3_path",
        _updated_at_text(ts).alias("updated_at"))


def current_status(ledger: DataFrame) -> DataFrame:
    """One row per file with its latest event (by ``updated_at`` parsed as
    a timestamp, then ``file_id``).  Partial aggregation per task, so a file
    with a huge event history costs one row per task in the shuffle."""
    ts = R("updated_at").try_cast("timestamp_ntz")
    w = F.struct(ts.alias("ts"), R("file_id"), R("status"), R("s3_path"), R("file_name"),
                 R("updated_at"))
    return (ledger.groupBy("original_file_id").agg(F.max(w).alias("_w"))
                  .select("original_file_id", R("_w.file_name").alias("file_name"),
                          R("_w.status").alias("status"), R("_w.s3_path").alias("s3_path"),
                          R("_w.updated_at").alias("updated_at"),
                          R("_w.file_id").alias("file_id")))


def latest_events(ledger: DataFrame, k: int = 10) -> DataFrame:
    """L3: the newest ``k`` ledger events (top-k: each task keeps its own k,
    the driver merges k × tasks rows)."""
    ts = R("updated_at").try_cast("timestamp_ntz")
    return ledger.orderBy(ts.desc_nulls_last(), R("file_id").desc()).limit(k)
