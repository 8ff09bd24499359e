"""MERGE of micro-batches into a keyed table that rewrites only what a batch touches.

Rows live in hash buckets of their key, ``bucket=<b>/gen=<batch>``.  A batch
reads the buckets that its keys fall into and writes these anew under its own
batch id; all other buckets stay where they are.  Its rows and the rows held are
moved once, to the parts of the buckets that will be written; there one
aggregation finds each key's last version and the row held before it, and the
result is written in the order of its versions, in which it packs best.  Nothing is
cached and no row is moved again.  A batch that moves many rows is merged some
buckets at a time, and what these shuffled goes before the next ones begin, so the
disk for moved rows does not grow with the batch.  A small
manifest per batch names the generation of each bucket, so a reader opens exactly
the current files, without listing older ones.  Rows without key match nothing:
each batch's are a folder of their own.

The same aggregation yields the batch's change rows (what a stream on the table
would return): an INSERT for a new key, a DELETE of the old values and an
INSERT of the new ones, both flagged as an update, for a changed row.  What a
batch did to a row is written beside it, in a column that readers of the
table do not ask for, and rows that it replaced go to a folder that lasts as long as the
merge; the change rows are read off both, task by task, and appended to a change table
under the batch id.

A replayed batch starts from the manifest before it and so writes the same
rows; once its manifest is there it does nothing.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.operators.changes import ACTION_DELETE, ACTION_INSERT
from tillroll.session import shuffles_dropped
from tillroll.streaming.commit import commit, file_system, put_file, read_json

#: Buckets of a new table; a bucket should be what a task can rewrite at ease.
BUCKETS = 64
#: Rows of a part: a bucket with more is written as several files, by as many tasks.
PART_ROWS = 100_000
#: Rows moved at a time, but for a bucket that has more; the batch is read once for each group of buckets that this makes.
MOVED_ROWS = 25_000_000
#: Codec of the table's and the change rows' files.
CODEC = "zstd"
MANIFESTS, UNKEYED = "_manifests", "unkeyed"
_NAME = "batch-{:012d}.json"
#: Partition column of the change rows: the batch that made them.
CHANGE_BATCH = "change_batch"
#: Column of a generation beside the table's: what its batch did to a row (null: nothing).
_CHANGE = "_change"
_INSERTED, _UPDATED = "insert", "update"
#: "Bucket" of the rows that a batch changed, as they were; their folder goes once the change rows are there.
_REPLACED, REPLACED = -1, "_replaced"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def batches(spark: SparkSession, root: str) -> list[int]:
    """Committed batch ids, ascending: one listing."""
    fs, folder = file_system(spark, f"{root}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[len("batch-"):-len(".json")]) for n in names if n.startswith("batch-") and n.endswith(".json"))


def manifest(spark: SparkSession, root: str, before: int | None = None) -> dict:
    """``{"buckets": n, "gens": {bucket: batch}, "unkeyed": [batch…]}`` of the newest batch (below ``before``)."""
    known = [b for b in batches(spark, root) if before is None or b < before]
    if not known:
        return {"buckets": None, "gens": {}, "unkeyed": []}
    return read_json(spark, f"{root}/{MANIFESTS}/{_NAME.format(known[-1])}")


def _read(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, root: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The table after its newest batch, or after the newest one below ``before``."""
    m = manifest(spark, root, before)
    paths = [f"{root}/bucket={b}/gen={g}" for b, g in sorted(m["gens"].items())]
    return _read(spark, paths + [f"{root}/{UNKEYED}/gen={g}" for g in m["unkeyed"]], schema)


def merge(batch: DataFrame, batch_id: int, root: str, schema: StructType, key: str, order: list[str], stamp: str,
          changes: str | None = None, ignore: tuple[str, ...] = (), buckets: int = BUCKETS, keep: int | None = None) -> None:
    """MERGE a batch of versions (columns of ``schema`` but ``stamp``) into the table at ``root``.

    Within the batch a key's last version under ``order`` wins; ``stamp`` is set to the
    time of the merge.  ``changes``: folder of the change rows; a row whose columns other than
    ``stamp`` and ``ignore`` are equal is not a change.  ``keep``: drop what none of the newest ``keep``
    batches reads once this one is committed (None: nothing goes)."""
    spark = batch.sparkSession
    known = batches(spark, root)
    if batch_id in known:
        return
    if known and batch_id < known[0]:
        raise ValueError(f"batch {batch_id} of {root} is older than the oldest one kept, {known[0]}")
    before = manifest(spark, root, batch_id)
    n = before["buckets"] or buckets
    cols = [f.name for f in schema.fields]
    now = F.lit(dt.datetime.now(dt.timezone.utc))  # one time, however often the batch is read
    rows = batch.select(*[c for c in cols if c != stamp]).withColumn(stamp, now)
    keyed = rows.filter(F.col(key).isNotNull())
    loose = rows.filter(F.col(key).isNull())
    met = {r[0]: r[1] for r in keyed.groupBy(bucket_of(key, n)).count().collect()}  # at most the number of buckets
    touched = sorted(met)
    unkeyed = list(before["unkeyed"])
    if not loose.isEmpty():
        loose.select(*cols).write.mode("overwrite").option("compression", CODEC).parquet(f"{root}/{UNKEYED}/gen={batch_id}")
        unkeyed.append(batch_id)
    if touched:
        compared = [c for c in cols if c not in (key, stamp, *ignore)]
        held = {b: f"{root}/bucket={b}/gen={before['gens'][str(b)]}" for b in touched if str(b) in before["gens"]}
        kept = _read(spark, list(held.values()), schema).groupBy(bucket_of(key, n)).count().collect()  # likewise
        moved = {b: met[b] for b in touched}
        for b, count in kept:
            moved[b] += count
        _drop(spark, f"{root}/{REPLACED}/gen={batch_id}")  # of an attempt that has no manifest
        for group in _groups(moved):
            old = _read(spark, [held[b] for b in group if b in held], schema)
            new = keyed if group == touched else keyed.filter(bucket_of(key, n).isin(group))
            parts = 1 + sum(moved[b] for b in group) // (len(group) * PART_ROWS)
            state = _state(old, new, cols, key, order, stamp, compared, n, parts, len(group), bool(changes))
            with shuffles_dropped(spark):
                _write(state, order, root, batch_id, group)
    if changes:
        made = _read(spark, [f"{root}/bucket={b}/gen={batch_id}" for b in touched],
                     StructType([*schema.fields, StructField(_CHANGE, StringType())]))
        gone = _read(spark, _folders(spark, f"{root}/{REPLACED}/gen={batch_id}"), schema)
        fresh = _read(spark, [f"{root}/{UNKEYED}/gen={batch_id}"] if batch_id in unkeyed else [], schema)
        made, update = made.filter(F.col(_CHANGE).isNotNull()), F.col(_CHANGE) == _UPDATED
        rows = _changes(made, cols, ACTION_INSERT, update).unionByName(_changes(gone, cols, ACTION_DELETE, F.lit(True)))
        rows = rows.unionByName(_changes(fresh, cols, ACTION_INSERT, F.lit(False))).withColumn(CHANGE_BATCH, F.lit(batch_id))
        commit({changes: rows}, batch_id, (CHANGE_BATCH,), codec=CODEC)
        _drop(spark, f"{root}/{REPLACED}/gen={batch_id}")
    gens = before["gens"] | {str(b): batch_id for b in touched}
    put_file(spark, f"{root}/{MANIFESTS}/{_NAME.format(batch_id)}", json.dumps({"buckets": n, "gens": gens, "unkeyed": unkeyed}))
    if keep is not None:
        vacuum(spark, root, keep)


def _groups(moved: dict[int, int]) -> list[list[int]]:
    """The buckets in groups of at most ``MOVED_ROWS`` rows to move; a larger bucket is a group of its own."""
    groups, total = [], 0
    for b, count in sorted(moved.items()):
        if not groups or total + count > MOVED_ROWS:
            groups.append([])
            total = 0
        groups[-1].append(b)
        total += count
    return groups


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []


def _state(old: DataFrame, batch: DataFrame, cols: list[str], key: str, order: list[str], stamp: str, compared: list[str],
           buckets: int, parts: int, touched: int, replaced: bool) -> DataFrame:
    """The touched buckets after the batch: columns ``cols``, what was done to the row, and the bucket;
    with ``replaced`` also the rows that it changed, as they were, in a bucket of their own.

    All versions of a key meet in one part of its bucket, sorted (a sort that spills), and
    are aggregated there; parts keep what a task sorts bounded."""
    ranked = [*order, *[c for c in cols if c not in (key, stamp, *order)]]
    both = old.select(*cols, F.lit(False).alias("_new")).unionByName(batch.select(*cols, F.lit(True).alias("_new")))
    part = F.pmod(F.xxhash64(F.lit("part"), F.col(key)), F.lit(parts)).cast("int")
    both = both.withColumn("bucket", bucket_of(key, buckets)).withColumn("_part", part)
    both = both.repartition(touched * parts, "bucket", "_part")
    rest = F.struct(*[F.col(c) for c in ranked], F.col(stamp))
    pairs = both.groupBy(key, "bucket", "_part").agg(
        F.max(F.when(~F.col("_new"), rest)).alias("_o"), F.max(F.when(F.col("_new"), rest)).alias("_n"))
    o, n = F.col("_o"), F.col("_n")
    same = F.lit(True)
    for c in compared:
        same = same & o.getField(c).eqNullSafe(n.getField(c))
    change = F.when(n.isNotNull() & o.isNull(), _INSERTED).when(n.isNotNull() & ~same, _UPDATED)

    def side(row):
        return [F.col(key) if c == key else row.getField(c).alias(c) for c in cols]

    now = F.coalesce("_n", "_o")
    if not replaced:
        return pairs.select(*side(now), change.alias(_CHANGE), "bucket")
    both = F.when(F.col(_CHANGE) == _UPDATED, F.array(now, "_o")).otherwise(F.array(now))
    each = pairs.withColumn(_CHANGE, change).select(key, _CHANGE, "bucket", F.posexplode(both).alias("_old", "_row"))
    was = F.col("_old") == 1
    return each.select(*side(F.col("_row")), F.when(~was, F.col(_CHANGE)).alias(_CHANGE),
                       F.when(was, _REPLACED).otherwise(F.col("bucket")).alias("bucket"))


def _changes(rows: DataFrame, cols: list[str], action: str, update: Column) -> DataFrame:
    return rows.select(*cols, F.lit(action).alias("change_action"), update.alias("change_isupdate"))


def _write(state: DataFrame, order: list[str], root: str, batch_id: int, touched: list[int]) -> None:
    """The touched buckets anew: written aside, then each bucket's folder gets its place, and so do the rows replaced."""
    spark = state.sparkSession
    aside = f"{root}/_aside/gen={batch_id}"
    writer = state.sortWithinPartitions("bucket", *order).write.mode("overwrite").option("compression", CODEC)
    writer.option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(aside)
    for b in touched:
        fs, target = file_system(spark, f"{root}/bucket={b}/gen={batch_id}")
        if fs.exists(target):
            fs.delete(target, True)  # an attempt that has no manifest
        fs.mkdirs(target.getParent())
        if not fs.rename(file_system(spark, f"{aside}/bucket={b}")[1], target):
            raise RuntimeError(f"could not place bucket {b} of {root}")
    fs, gone = file_system(spark, f"{aside}/bucket={_REPLACED}")
    if fs.exists(gone):
        target = file_system(spark, f"{root}/{REPLACED}/gen={batch_id}/from={touched[0]}")[1]
        fs.mkdirs(target.getParent())
        if not fs.rename(gone, target):
            raise RuntimeError(f"could not place the replaced rows of {root}")
    _drop(spark, aside)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Drop bucket generations that none of the newest ``keep`` batches reads, and older manifests;
    the number of folders dropped."""
    known = batches(spark, root)
    kept = known[-keep:]
    needed = {(int(b), g) for k in kept for b, g in manifest(spark, root, k + 1)["gens"].items()}
    dropped = 0
    for b in {b for b, _ in needed}:
        fs, folder = file_system(spark, f"{root}/bucket={b}")
        for s in fs.listStatus(folder):
            name = s.getPath().getName()
            if name.startswith("gen=") and (b, int(name[4:])) not in needed and int(name[4:]) <= known[-1]:
                dropped += bool(fs.delete(s.getPath(), True))
    for k in known[:-keep]:
        fs, p = file_system(spark, f"{root}/{MANIFESTS}/{_NAME.format(k)}")
        fs.delete(p, False)
    return dropped

