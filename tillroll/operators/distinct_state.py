"""Exact distinct counts that merge: ids are numbered once, each day keeps bitmaps of numbers.

``COUNT(DISTINCT …)`` of a month is not the sum of its days' counts, so a plain
aggregate reads all lines of a period again.  Here each id gets a number when it
is first seen, and a batch leaves, for each of its days and groups, bitmaps of
the numbers that it met.  Bitmaps of any days and groups merge with a bitwise
or, so a count over any period reads only state, and only that of its months.

* Numbers run within shards (a hash of the id), one window of distinct ids per
  shard, in order of the first day: a day's new ids lie together, which keeps
  its bitmaps dense.  ``shards`` bounds the ids in one task; it may be raised
  between batches.
* A bitmap holds 32,768 numbers (4 KB).  A day holds at most one per block of
  numbers that it touches, never more than it has ids.
* A batch's lines are read once per id column: its distinct ids per day and group are written
  aside, and both its new ids and its bitmaps are made from them.
* A batch is committed under its number (:mod:`tillroll.streaming.commit`), the ids
  before the bitmaps; a replay finds what is there and adds the rest.  Adding the
  same lines again changes no count, so late lines and lines read twice need no care.
  Lines are never taken away.  One writer at a time.
* NULL ids are not counted, as in ``COUNT(DISTINCT)``; a group that holds only such
  is there, with 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.streaming import commit

MONTH = "month"
SHARDS = 16


@dataclass(frozen=True)
class DistinctState:
    """Where a state lies and what it counts: ``ids`` per ``day`` (a DATE) and ``groups``, a DDL list."""

    root: str
    ids: tuple[str, ...]
    day: str
    groups: str = ""
    shards: int = SHARDS

    def _ids_at(self, name: str) -> str:
        return f"{self.root}/ids/{name}"

    def _bits_at(self, name: str) -> str:
        return f"{self.root}/bits/{name}"

    def _numbers(self, spark: SparkSession, name: str) -> DataFrame:
        commit.make_folder(spark, self._ids_at(name))
        return spark.read.schema("id string, shard long, number long").parquet(self._ids_at(name))

    def _bits(self, spark: SparkSession, name: str) -> DataFrame:
        commit.make_folder(spark, self._bits_at(name))
        groups = f"{self.groups}, " if self.groups else ""
        schema = f"{self.day} date, {groups}shard long, block long, bits binary, {MONTH} date"
        return spark.read.schema(schema).parquet(self._bits_at(name))

    def _group_names(self, spark: SparkSession) -> list[str]:
        return spark.createDataFrame([], self.groups).columns if self.groups else []

    def _met(self, rows: DataFrame, name: str, folder: str) -> DataFrame:
        """The batch's ids per day and group, once each, written: new ids and bitmaps both come from them."""
        by = [self.day, *self._group_names(rows.sparkSession)]
        met = rows.select(*by, F.col(name).cast("string").alias(name)).distinct()
        met.write.mode("overwrite").parquet(folder)
        return rows.sparkSession.read.schema(met.schema).parquet(folder)

    def _new_ids(self, rows: DataFrame, name: str) -> DataFrame:
        """Ids that have no number yet, numbered behind the last of their shard."""
        known = self._numbers(rows.sparkSession, name)
        seen = rows.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("string").alias("id")).agg(
            F.min(self.day).alias("first"))
        new = seen.join(known.select("id"), "id", "left_anti").withColumn(
            "shard", F.pmod(F.xxhash64("id"), F.lit(self.shards).cast("long")))
        last = known.groupBy("shard").agg(F.max("number").alias("last"))
        order = Window.partitionBy("shard").orderBy("first", "id")
        return new.join(last, "shard", "left").select(
            "id", "shard", (F.coalesce("last", F.lit(0)) + F.row_number().over(order)).cast("long").alias("number"))

    def _new_bits(self, rows: DataFrame, name: str, once: bool = False) -> DataFrame:
        """One bitmap for each day, group and block of numbers of the batch (``once``: rows are distinct)."""
        by = [self.day, *self._group_names(rows.sparkSession)]
        met = rows.select(*by, F.col(name).cast("string").alias("id"))
        met = met if once else met.distinct()
        met = met.join(self._numbers(rows.sparkSession, name), "id", "left")
        number = F.when(F.col("id").isNull() | F.col("number").isNotNull(), F.col("number")).otherwise(
            F.raise_error(F.concat(F.lit(f"{name} without a number: "), "id")).cast("long"))
        met = met.withColumn("number", number)
        bits = met.groupBy(*by, "shard", F.bitmap_bucket_number("number").alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        bits = bits.withColumn(MONTH, F.trunc(self.day, "MM"))
        return bits.hint("rebalance", MONTH).sortWithinPartitions(MONTH, self.day)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Take in a batch of rows with the day, the groups and the ids.  A batch that is there stays as it is."""
        spark = rows.sparkSession
        for name in self.ids:
            if commit.exists(spark, commit.marker(self._bits_at(name), batch_id)):
                commit.publish(spark, self._bits_at(name), batch_id)
                continue  # its ids were committed before
            folder = f"{self.root}/_met/{name}/batch-{batch_id:012d}"
            met = self._met(rows, name, folder)
            commit.commit({self._ids_at(name): self._new_ids(met, name)}, batch_id)
            commit.commit({self._bits_at(name): self._new_bits(met, name, once=True)}, batch_id, (MONTH,))
            fs, path = commit.file_system(spark, folder)
            fs.delete(path, True)

    def counts(self, spark: SparkSession, by: Sequence[Column] = (), first=None, last=None) -> DataFrame:
        """Distinct ids per ``by`` (named expressions over the day and the groups; none: one row),
        one ``unique_<id>`` column each.  With ``first`` and ``last`` (dates) only days between
        them, and only their months' folders are read."""
        parts = []
        for name in self.ids:
            bits = self._bits(spark, name)
            for bound, keep in ((first, "__ge__"), (last, "__le__")):
                if bound is not None:
                    bound = F.lit(bound).cast("date")
                    bits = bits.where(getattr(F.col(self.day), keep)(bound) & getattr(F.col(MONTH), keep)(F.trunc(bound, "MM")))
            parts.append(bits.select(*by, F.lit(name).alias("_of"), "shard", "block", "bits"))
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        keys = [c for c in rows.columns if c not in ("_of", "shard", "block", "bits")]
        merged = rows.groupBy(*keys, "_of", "shard", "block").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
        return merged.groupBy(*keys).agg(*[
            F.coalesce(F.sum(F.when(F.col("_of") == name, F.col("n"))), F.lit(0)).cast("long").alias(f"unique_{name}")
            for name in self.ids])
