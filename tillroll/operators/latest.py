"""Last-writer-wins per key (the definition form of an upsert).

``MERGE … WHEN MATCHED UPDATE ALL / WHEN NOT MATCHED INSERT`` with no delete
branch leaves, for every key, the row of the last processed version.  Over an
append-only log that is "max row per key under the processing order".

It is written as ``groupBy(key).agg(max(struct(order…, rest…)))`` rather than
``row_number()`` over a window: the aggregate combines map-side, so every
task ships at most one row per key to the shuffle.  A key holding a third of
all versions then costs one row per input partition, not one giant sorted
window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per ``key``: the greatest under ``order``, ties broken by
    the remaining columns in declared order (a total, deterministic order;
    NULL sorts lowest).  NULL keys form one group here; see
    ``silver.upsert_orders`` for MERGE semantics of NULL keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(columns or df.columns)
    rest = [c for c in cols if c not in keys and c not in order]
    ranked = F.struct(*[F.col(c) for c in list(order) + rest]).alias("_w")
    out = df.groupBy(*keys).agg(F.max(ranked).alias("_w"))
    return out.select(*[F.col(k) for k in keys],
                      *[F.col(f"_w.{c}").alias(c) for c in cols if c not in keys]
                      ).select(*cols)
