"""Reading declared tables for the jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the needed columns: the scan's ``ReadSchema`` is pruned to them."""
    return spark.read.parquet(path).select(*columns)
