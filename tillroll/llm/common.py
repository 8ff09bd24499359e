"""Helpers shared by the training-data operators.

Tables that are used more than once, or that cut a long lineage, are written
below the folder the cluster names in ``spark.checkpoint.dir``; all executors
and the driver see it.  Files that are not Parquet (archives, indexes, token
files) go through :mod:`pyarrow.fs`, so any store it knows can hold them.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder (URI or path) below ``spark.checkpoint.dir``.

    Unset is only accepted on one machine (``local[...]``), as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "tillroll-" + spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/tillroll-llm/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of ``uri`` and the path in it; a plain path is a local one."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[len("file:"):])
    return pafs.LocalFileSystem(), os.path.abspath(uri)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def clash_free(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns cannot clash with derived ones."""
    return df.select(*names)


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with one value of the integer column ``key``, as tables.

    The input is sorted by the key within its partition; one run is in memory.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            if held and keys[lo] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = keys[lo]
    if held:
        yield pa.Table.from_batches(held)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)`` of BIGINT ids.

    The component is its smallest node.  Each round hooks every node to the
    neighbour (or itself) that comes first in an order, follows the hook that this
    one has, and replaces the nodes of all links by what they reach; links inside
    one node vanish.  The first order is that of the ids, as links mostly lead to
    a group's smallest; later ones are drawn anew from a hash.  Rounds grow with
    the logarithm of the largest component.
    Joins are between written tables, so a hub's rows can be split at run time.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct()
    edges = written(edges, "edges")
    both = edges.select("a").union(edges.select("b")).distinct()
    labels = written(both.select(F.col("a").alias("node"), F.col("a").alias("root")), "labels")
    turn = 0
    while not edges.isEmpty():
        around = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(
            edges.select("b", "a"))

        def order(c, turn=turn):
            return F.xxhash64(F.col(c), F.lit(turn)) if turn else F.col(c)

        first = F.min(F.struct(order("y").alias("h"), F.col("y")))
        own = F.struct(order("x").alias("h"), F.col("x").alias("y"))
        hooks = written(around.groupBy("x").agg(first.alias("n"))
                        .select("x", F.least("n", own)["y"].alias("to")), "hooks")
        # the links of x to its hook and on lead along all that it passes, so nothing comes apart
        onward = hooks.select(F.col("x").alias("to"), F.col("to").alias("then"))
        hooks = written(hooks.join(onward, "to").select("x", F.col("then").alias("to")), "hooks")
        labels = written(
            labels.join(hooks, labels["root"] == hooks["x"], "left")
            .select("node", F.coalesce("to", "root").alias("root")), "labels")
        onto = edges.join(hooks.withColumnRenamed("to", "a2"), F.col("a") == F.col("x")).select("a2", "b")
        onto = onto.join(hooks.withColumnRenamed("to", "b2"), F.col("b") == F.col("x"))
        edges = written(
            onto.where("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "edges")
        turn += 1
    least = written(labels.groupBy("root").agg(F.min("node").alias("component")), "least")
    return labels.join(least, "root").select("node", "component")


def with_links(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: only what these tie together is worked through again."""
    of = {side: components.select(F.col("node").alias(f"n{side}"), F.col("component").alias(f"c{side}")) for side in "ab"}
    tied = links.join(of["a"], F.col("a") == F.col("na"), "left").join(of["b"], F.col("b") == F.col("nb"), "left")
    tied = tied.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = connected_components(tied).select(F.col("node").alias("was"), F.col("component").alias("now"))
    merged = written(merged, "merged")
    moved = components.join(merged, F.col("component") == F.col("was"), "left")
    fresh = merged.join(components, F.col("was") == F.col("node"), "left_anti")
    return moved.select("node", F.coalesce("now", "component").alias("component")).union(fresh.select("was", "now"))
