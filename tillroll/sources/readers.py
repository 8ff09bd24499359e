"""File formats of the three feeds, batch and streaming, with lineage.

* JSON (sensor events) → one VARIANT payload per event, whether a file holds an
  outer array or one event per line.  Files are cut into the texts of their
  events by byte ranges (:mod:`tillroll.sources.json_events`) and each text is
  parsed as it is: unknown fields and values of other types stay.  A text that
  is no JSON object goes to a quarantine with its file, position and reason.
* CSV (POS lines) → 19 text fields bound by position, header skipped,
  optional ``"`` quoting.  PERMISSIVE parsing with a corrupt-record column:
  short/long rows and unparsable numbers go to a quarantine dataset, good
  rows go on.
* Parquet (ERP orders/inventory) → columns matched by name, case-insensitive;
  missing columns NULL, extra columns ignored; files picked by name pattern.

Every reader returns bronze rows with ``source_file`` (``_metadata``) and
``loaded_time`` (``current_timestamp()``: one value per query or micro-batch).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import (
    BooleanType, DataType, DateType, IntegerType, NumericType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

from tillroll import schemas
from tillroll.functions.expr import to_long_rounded
from tillroll.plans import silver
from tillroll.sources import json_events

CORRUPT = "_corrupt_record"
# File-name patterns of the ERP feed.
ORDERS_GLOB = "*orders*.parquet"
INVENTORY_GLOB = "*inventory*.parquet"
ORDERS_PATH_REGEX = r".*orders.*[.]parquet"
INVENTORY_PATH_REGEX = r".*inventory.*[.]parquet"


def _lineage() -> list[Column]:
    return [F.col("_metadata.file_path").alias("source_file"),
            F.current_timestamp().alias("loaded_time")]


# A file counts as new however old it is: the source's own limit of a week would leave
# late deliveries out.  A back-fill runs in batches of so many files.
MAX_FILE_AGE = "36500d"
MAX_FILES_PER_TRIGGER = 1000


def _reader(spark: SparkSession, stream: bool) -> DataFrameReader | DataStreamReader:
    if not stream:
        return spark.read
    return (spark.readStream.option("maxFileAge", MAX_FILE_AGE)
            .option("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER))


# ---------------------------------------------------------------- JSON
def _layout(layout: str) -> bool:
    if layout not in ("array", "lines"):
        raise ValueError("layout must be 'array' or 'lines'")
    return layout == "array"


def list_json_files(spark: SparkSession, path: str, stream: bool = False, glob: str | None = None) -> DataFrame:
    """``path, length`` of all files below a folder; their content is not read."""
    r = _reader(spark, stream).format("binaryFile").option("recursiveFileLookup", "true").schema(
        "path string, modificationTime timestamp, length long, content binary")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length")


def json_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The lines of text files as records (``json_events.RECORDS``); blank lines hold nothing."""
    r = _reader(spark, stream).format("text").option("recursiveFileLookup", "true")
    return r.load(path).where(F.length(F.btrim("value")) > 0).select(
        F.col("value").alias("record"), F.lit(None).cast("string").alias("fault"),
        F.col("_metadata.file_path").alias("source_file"), F.lit(None).cast("long").alias("position"))


def read_json_records(spark: SparkSession, path: str, layout: str = "array",
                      range_bytes: int = json_events.RANGE_BYTES) -> DataFrame:
    """Records ``record, fault, source_file, position, loaded_time`` of JSON files:
    ``array``: an array of events or objects one after another per file, cut by byte
    ranges; ``lines``: one event per line."""
    if _layout(layout):
        rows = json_events.cut_events(list_json_files(spark, path), range_bytes)
    else:
        rows = json_lines(spark, path)
    return rows.withColumn("loaded_time", F.current_timestamp())


def read_json_events_typed(spark: SparkSession, path: str, layout: str = "array",
                           stream: bool = False) -> DataFrame:
    """One row per event as ``schemas.IOT_EVENT``: a typed view of files whose types are
    known to hold.  What does not parse is a row with only ``_corrupt_record``; the
    load itself goes through :func:`read_json_records`, which keeps all."""
    schema = StructType([*schemas.IOT_EVENT.fields, StructField(CORRUPT, StringType(), True)])
    r = (_reader(spark, stream).format("json").schema(schema)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
         .option("recursiveFileLookup", "true").option("multiLine", _layout(layout)))
    return r.load(path).select("*", *_lineage())


def split_json(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``raw_payload, source_file, loaded_time`` of each event; quarantined
    ``record, reason, source_file, position, loaded_time``).

    Every record is in one of the two: an event is a whole JSON object, whatever its
    fields hold.  Both sides come from the same parse of the same column, so nothing
    that one side leaves out can be missed by the other."""
    payload = F.when(F.col("fault").isNull(), F.try_parse_json("record"))
    tagged = records.withColumn("raw_payload", payload)
    reason = F.coalesce(
        F.col("fault"), F.when(F.col("raw_payload").isNull(), F.lit("malformed_json")),
        F.when(~F.schema_of_variant("raw_payload").startswith("OBJECT"), F.lit("not_an_object")))
    tagged = tagged.withColumn("reason", reason)
    good = tagged.filter(F.col("reason").isNull()).select("raw_payload", "source_file", "loaded_time")
    bad = tagged.filter(F.col("reason").isNotNull()).select("record", "reason", "source_file", "position", "loaded_time")
    return good, bad


def read_json_payload(spark: SparkSession, path: str, layout: str = "array") -> DataFrame:
    """``stg_json_iot`` rows ``raw_payload, source_file, loaded_time``, one per event."""
    return split_json(read_json_records(spark, path, layout))[0]


# ---------------------------------------------------------------- CSV
def pos_csv_reader(spark: SparkSession, stream: bool = False):
    schema = StructType(list(schemas.POS_CSV_TEXT.fields)
                        + [StructField(CORRUPT, StringType(), True)])
    return (_reader(spark, stream).format("csv").schema(schema)
            .option("header", True).option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("recursiveFileLookup", "true"))


def read_pos_csv(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Raw POS lines as 19 text fields + corrupt record + lineage."""
    return pos_csv_reader(spark, stream).load(path).select(
        *schemas.POS_CSV_FIELDS, CORRUPT, *_lineage())


_NUMERIC = ("quantity", "unit_price", "discount_pct", "total_amount", "loyalty_points")
# Numbers from here on, and those that are not finite, are not staged: sums of money
# stay exact, and whole numbers fit a BIGINT.
OUT_OF_RANGE = 1e15


def quarantine_reason(raw: DataFrame) -> Column:
    """Why a raw POS row cannot be staged: malformed line, a number that does not
    parse, is not finite or out of range, or unparsable date/time.  NULL for good rows."""
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed_row"))]
    for c in _NUMERIC:
        number = F.col(c).try_cast("double")
        fits = F.coalesce(F.abs(number) < OUT_OF_RANGE, F.lit(False))  # NaN is above every number
        reasons.append(F.when(F.col(c).isNotNull() & ~fits, F.lit(f"bad_{c}")))
    ts_text = F.concat(F.col("transaction_date"), F.lit(" "), F.col("transaction_time"))
    reasons.append(F.when(F.col("transaction_date").isNotNull()
                          & F.col("transaction_time").isNotNull()
                          & ts_text.try_cast("timestamp_ntz").isNull(),
                          F.lit("bad_timestamp")))
    return F.coalesce(*reasons)


def split_pos(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S14 with a quarantine: (staged good rows, quarantined raw rows)."""
    tagged = raw.withColumn("_reason", quarantine_reason(raw))
    good = silver.stage_pos(tagged.filter(F.col("_reason").isNull()),
                            source_file=F.col("source_file"), loaded_time=F.col("loaded_time"))
    bad = tagged.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return good, bad


def typed_pos_raw(raw: DataFrame) -> DataFrame:
    """S12 positional bulk load into the typed raw table (``pos_transactions``)."""
    out = []
    for f in schemas.POS_RAW.fields:
        t = f.dataType.simpleString()
        c = F.col(f.name)
        if t == "bigint":
            out.append(to_long_rounded(c, StringType()).alias(f.name))
        else:
            out.append(c.try_cast(t).alias(f.name))
    return raw.select(*out, "source_file", "loaded_time")


# ---------------------------------------------------------------- Parquet
def parquet_reader(spark: SparkSession, schema: StructType, glob: str | None,
                   stream: bool = False):
    r = (_reader(spark, stream).format("parquet").schema(schema)
         .option("recursiveFileLookup", "true"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r


def read_erp_orders(spark: SparkSession, path: str, stream: bool = False,
                    path_regex: str | None = None) -> DataFrame:
    """Order files (base name ``*orders*.parquet``) → bronze.

    ``path_regex`` matches the full path instead (a directory name can carry
    the match); it is a row filter on ``_metadata.file_path``, so prefer the
    glob, which prunes at listing."""
    glob = None if path_regex else ORDERS_GLOB
    df = parquet_reader(spark, schemas.ERP_ORDERS, glob, stream).load(path)
    if path_regex:
        df = df.filter(F.col("_metadata.file_path").rlike(path_regex))
    return silver.stage_orders(df)


def read_erp_inventory(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    df = parquet_reader(spark, schemas.ERP_INVENTORY, INVENTORY_GLOB, stream).load(path)
    return df.select(*[f.name for f in schemas.ERP_INVENTORY.fields], *_lineage())


# ---------------------------------------------------------------- S22
def normalize_name(name: str) -> str:
    """Column-name rule for parquet batches: trim, lower case, inner runs of
    spaces/dashes/dots to ``_``."""
    return re.sub(r"[\s\-.]+", "_", name.strip().lower())


def conform(df: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename columns by ``normalize_name``, then project the declared
    schema: declared order, cast per column (NULL when it does not fit),
    missing columns NULL, extra columns dropped (``keep`` passes through)."""
    renamed = _renamed(df, keep)
    return renamed.select(*_conformed(renamed, schema), *keep)


def _renamed(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.toDF(*[c if c in keep else normalize_name(c) for c in df.columns])


def _fit(c: Column, source: DataType, target: DataType) -> Column:
    """A value of a file's own type as the declared type; NULL where it does not fit."""
    t = target.simpleString()
    if isinstance(target, DateType):
        fits = isinstance(source, (StringType, DateType, TimestampType, TimestampNTZType))
        return c.try_cast(t) if fits else F.lit(None).cast(t)  # a number is no date
    if isinstance(target, (NumericType, BooleanType)) and not isinstance(source, (NumericType, BooleanType, StringType)):
        c, source = c.cast("string"), StringType()
    if t == "bigint":
        return to_long_rounded(c.cast("int"), IntegerType()) if isinstance(source, BooleanType) else to_long_rounded(c, source)
    return c.try_cast(t)


def _conformed(renamed: DataFrame, schema: StructType) -> list[Column]:
    have = {f.name: f.dataType for f in renamed.schema.fields}
    return [(_fit(F.col(f.name), have[f.name], f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]


def split_conformed(df: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """:func:`conform` with a quarantine: (conformed rows; ``record, reason, …keep`` of rows
    with a value that its declared type cannot hold)."""
    renamed = _renamed(df, keep)
    have = set(renamed.columns)
    typed = dict(zip([f.name for f in schema.fields], _conformed(renamed, schema), strict=True))
    reasons = [F.when(F.col(n).isNotNull() & c.isNull(), F.lit(f"bad_{n}")) for n, c in typed.items() if n in have]
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    tagged = renamed.withColumn("_reason", reason)
    good = tagged.filter(F.col("_reason").isNull()).select(*typed.values(), *keep)
    raw = [F.col(c).cast("string").alias(c) for c in renamed.columns if c not in keep]
    bad = tagged.filter(F.col("_reason").isNotNull()).select(
        F.to_json(F.struct(*raw)).alias("record"), F.col("_reason").alias("reason"), *keep)
    return good, bad


def parquet_layouts(files: DataFrame) -> DataFrame:
    """``path, layout, reason`` of the files ``(path)``: the schema in each footer, which
    tasks read, or why the file cannot be loaded."""
    def footers(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                try:
                    with json_events.open_file(path) as f:
                        layout = pq.read_schema(f).remove_metadata()
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                    found.append((path, None, "unreadable_file"))
                    continue
                names = [normalize_name(n) for n in layout.names]
                twice = len(set(names)) < len(names)
                found.append((path, layout.to_string(), "ambiguous_columns" if twice else None))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.string()) for i in range(3)],
                                             names=["path", "layout", "reason"])

    tasks = files.sparkSession.sparkContext.defaultParallelism
    return files.select("path").repartition(tasks, "path").mapInArrow(footers, "path string, layout string, reason string")


def load_parquet_files(files: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(good; quarantined) rows of one batch of files ``(path)`` whose column names, order,
    widths and types differ.

    Files are grouped by the schema of their own footers; each group is one scan, conformed
    to the declared schema, and the groups, as many as there are layouts, are unioned.
    The batch's paths pass through the driver, as in every file source; a stream bounds
    them by its files per trigger.  Quarantined: rows with values that do not fit, and
    whole files that cannot be read (``record`` is NULL)."""
    spark = files.sparkSession
    groups: dict[str, list[str]] = {}
    faulty = []
    for r in parquet_layouts(files).collect():
        if r["reason"]:
            faulty.append((None, r["reason"], r["path"]))
        else:
            groups.setdefault(r["layout"], []).append(r["path"])
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    good = spark.createDataFrame([], f"{names}, source_file string")
    bad = spark.createDataFrame(faulty, "record string, reason string, source_file string")
    for layout in sorted(groups):
        raw = spark.read.parquet(*sorted(groups[layout]))
        raw = raw.select("*", F.col("_metadata.file_path").alias("source_file"))
        fits, held = split_conformed(raw, schema, keep=("source_file",))
        good, bad = good.unionByName(fits), bad.unionByName(held)
    now = F.current_timestamp()
    return good.withColumn("loaded_time", now), bad.withColumn("loaded_time", now)


def read_parquet_batches(spark: SparkSession, files: list[str], schema: StructType) -> DataFrame:
    """The good rows of :func:`load_parquet_files` for a list of paths, values that do not fit NULL."""
    groups: dict[str, list[str]] = {}
    for r in parquet_layouts(spark.createDataFrame([(f,) for f in files], "path string")).collect():
        groups.setdefault(r["layout"], []).append(r["path"])
    out = None
    for paths in groups.values():
        raw = spark.read.parquet(*sorted(paths))
        raw = raw.select("*", F.col("_metadata.file_path").alias("source_file"))
        part = conform(raw, schema, keep=("source_file",))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("loaded_time", F.current_timestamp())
