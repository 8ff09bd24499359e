"""The corpus pipeline: stages over ``documents``, each written and read again.

Toxic documents go, one document of each near-duplicate group stays, documents
with benchmark passages go, sources are mixed to their target weights in
training order, and the mix is written as token-id files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import curriculum, minhash, templates, token_files, toxicity
from tillroll.llm.common import read_table, written
from tillroll.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the toxicity threshold; labels are learned from what the input holds."""
    return toxicity.reject(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, 0.8)."""
    return minhash.keep_first(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised ones included."""
    return templates.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order; a document that is taken twice is two rows."""
    return curriculum.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mix: ``doc_id, start, n_tokens, ids_crc32``, read back from the token files."""
    return token_files.read_token_files(token_files.write_token_files(docs, tokenizer_path(), end_id=2))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_output", token_output),
]

#: Compression lengths, token ids and files cannot be put in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
