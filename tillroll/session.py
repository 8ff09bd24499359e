"""Session defaults for the library.

On a cluster the deployment owns sizing (executors, shuffle partitions, the
shared checkpoint folder).  ``build_session`` only fills what is unset, so the
same code runs under ``spark-submit`` and in local tests.
"""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs rely on for their semantics (not for sizing).
SEMANTIC_CONF = {
    # All event times are TIMESTAMP_NTZ; load/process times print in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Gold facts are rewritten one report_date partition at a time.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Runtime re-planning: coalesce tiny shuffles, split skewed partitions,
    # demote sort-merge joins to broadcast when a side proves small at runtime.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tillroll",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the library's semantic settings.

    ``master`` and ``shuffle_partitions`` are for local runs; leave them None
    under a cluster manager.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SEMANTIC_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Jobs that cut lineage or keep stream state write below it.  A cluster has to
    name one; only a one-machine session (``local[...]``, as in tests) without
    the setting gets a folder of its application in the temporary directory.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        d = os.path.join(tempfile.gettempdir(), f"tillroll-ckpt-{spark.sparkContext.applicationId}")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def state_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (stream state, generations)."""
    return os.path.join(checkpoint_dir(spark), *parts)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What a write in this block shuffles goes when the write ends.  Else it stays on the executors' disks until
    the driver happens to collect its garbage, one job's beside the next one's."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
