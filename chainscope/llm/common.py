"""Helpers shared by the operators of this subpackage.

Texts are always processed whole; a null text counts as the empty text.
Only the columns an operator names are read, so extra input columns never
clash with the columns it adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters that separate words: space and \x09-\x0D (ASCII only).
WORD_SEP = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string never null)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def keyed_text(docs: DataFrame) -> DataFrame:
    """(key string, text string never null): ids travel through Python as
    text, since a pandas column of numbers with a null among them is of
    doubles, which change ids above 2^53."""
    return docs.select(F.col("doc_id").cast("string").alias("key"), F.coalesce("text", F.lit("")).alias("text"))


def map_keyed(rows: DataFrame, run, schema: str, key: str = "doc_id") -> DataFrame:
    """``rows.mapInPandas(run, schema)`` with the ids of column ``key`` (long
    in ``schema``) sent through Python as text, for the same reason."""
    got = rows.withColumn(key, F.col(key).cast("string")).mapInPandas(run, schema.replace(f"{key} long", f"{key} string", 1))
    return got.withColumn(key, F.col(key).cast("long"))


def byte_words(text: str) -> list[bytes]:
    """UTF-8 words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.

    ``bytes.lower`` touches ASCII only and ``bytes.split`` cuts at exactly the
    six separators.
    """
    return text.encode("utf-8", "replace").lower().split()


def filter_computed(df: DataFrame, condition) -> DataFrame:
    """Filter on costly computed columns without recomputing them.

    The optimizer pushes a plain filter below the projections it reads and
    writes their expressions out in full, once per mention and, inside
    lambdas, once per element. A row number in the condition stops that.
    """
    row = "_computed_row"
    return df.withColumn(row, F.monotonically_increasing_id()).filter(condition & (F.col(row) >= 0)).drop(row)
