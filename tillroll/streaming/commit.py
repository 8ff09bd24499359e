"""One batch, several outputs, each committed once.

A micro-batch is written to every output under its batch id.  An output is
first written whole to a staging folder (hidden from readers), with its row
count observed while it is written.  Then its files move, under the names they
have, to where readers see them, and a marker with the batch's figures ends
the commit.  A replay finds one of three states and goes on from it: the
marker (nothing to do), a complete staging folder (move what is left; names
are the same), or neither (write again; nothing was visible).  So a reader sees
each file once, however often the driver dies.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MARKERS, STAGING = "_batches", "_staging"


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.mkdirs(p)


def read_json(spark: SparkSession, path: str):
    """The content of a small JSON file; None if it is not there."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def put_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written beside, then renamed."""
    fs, p = file_system(spark, path)
    beside = file_system(spark, f"{path}.part")[1]
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.mkdirs(p.getParent())
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(beside, p):
        raise RuntimeError(f"could not write {path}")


def marker(root: str, batch_id: int) -> str:
    return f"{root}/{MARKERS}/batch-{batch_id:012d}.json"


def stage(rows: DataFrame, root: str, batch_id: int, partition_by: tuple[str, ...] = (),
          measures: dict | None = None, codec: str | None = None) -> None:
    """Write one output's rows where no reader looks; their figures are observed on the way.
    ``codec``: of the files, else the session's."""
    spark = rows.sparkSession
    folder = f"{root}/{STAGING}/batch-{batch_id:012d}"
    if exists(spark, marker(root, batch_id)) or exists(spark, f"{folder}/_figures.json"):
        return
    seen = Observation()
    figures = {"rows": F.count(F.lit(1)), **(measures or {})}
    writer = rows.observe(seen, *[c.alias(n) for n, c in figures.items()]).write.mode("overwrite")
    if codec:
        writer = writer.option("compression", codec)
    # all partitions of an earlier, incomplete attempt go
    writer.option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(folder)
    put_file(spark, f"{folder}/_figures.json", json.dumps({"batch_id": batch_id, **seen.get}, default=str))


def publish(spark: SparkSession, root: str, batch_id: int) -> None:
    """Move a staged output's files to where readers see them; the marker ends the commit."""
    folder = f"{root}/{STAGING}/batch-{batch_id:012d}"
    fs, staged = file_system(spark, folder)
    if not exists(spark, marker(root, batch_id)):
        base = fs.makeQualified(staged).toString()
        files = fs.listFiles(staged, True)
        moves = []
        while files.hasNext():
            path = files.next().getPath()
            if not path.getName().startswith(("_", ".")):
                moves.append((path, path.toString()[len(base) + 1:]))
        for path, inner in moves:
            target = file_system(spark, f"{root}/{inner}")[1]
            fs.mkdirs(target.getParent())
            if not fs.rename(path, target) and not fs.exists(target):
                raise RuntimeError(f"could not move {path.toString()} to {root}")
        fs.mkdirs(file_system(spark, f"{root}/{MARKERS}")[1])
        figures = file_system(spark, f"{folder}/_figures.json")[1]
        if not fs.rename(figures, file_system(spark, marker(root, batch_id))[1]):
            raise RuntimeError(f"could not commit batch {batch_id} of {root}")
    if fs.exists(staged):
        fs.delete(staged, True)


def commit(outputs: dict[str, DataFrame], batch_id: int, partition_by: tuple[str, ...] = (),
           measures: dict | None = None, codec: str | None = None) -> None:
    """Write a batch's outputs (folder → rows), all staged before the first is shown."""
    spark = next(iter(outputs.values())).sparkSession
    for root, rows in outputs.items():
        stage(rows, root, batch_id, partition_by, measures, codec)
    for root in outputs:
        publish(spark, root, batch_id)


def load_figures(spark: SparkSession, root: str, more: str = "") -> DataFrame:
    """V1 without a scan: ``batch_id, rows`` (and ``more`` measures, as a DDL list) of every
    committed batch, as observed while it was written."""
    schema = "batch_id long, rows long" + (f", {more}" if more else "")
    if not exists(spark, f"{root}/{MARKERS}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{root}/{MARKERS}")
