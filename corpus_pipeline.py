"""Training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet in
the shared checkpoint folder and reread as the next stage's ``docs``. All but
the last return the columns of ``documents``; every stage works on all rows
its predecessor kept, and its decisions take effect. An empty table gives an
empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainscope.llm import byte_bpe, pii, quality_rules, simhash, soft_mixing
from chainscope.llm.common import table
from chainscope.operators.lineage import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; failing lines of kept ones are removed."""
    return quality_rules.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the smallest id."""
    return simhash.dedup(spark, docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    return pii.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are repeated or left out by their fitted rates."""
    return soft_mixing.mix(spark, docs, table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the decoded bytes' digest of every row."""
    return byte_bpe.digests(spark, docs)


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("pii", personal_data),
          ("mixing", mixing), ("byte_bpe", tokens)]

# Fingerprints, fitted rates and BPE merges are beyond SQL. A test runs the
# stages one after another and holds each one's rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
