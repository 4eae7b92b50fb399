"""Scans of the ledger tables (CSV export or Parquet).

Every reader returns a DataFrame with an explicit schema, so the scan never
infers types and Catalyst prunes columns / pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.sources import schemas

_TEXT_SCHEMAS = {
    "transactions": schemas.TRANSACTIONS_TEXT,
    "contracts": schemas.CONTRACTS_TEXT,
    "blocks": schemas.BLOCKS_TEXT,
}
_TYPERS = {
    "transactions": schemas.typed_transactions,
    "contracts": schemas.typed_contracts,
    "blocks": schemas.typed_blocks,
}


def read_ledger_csv(spark: SparkSession, path: str, kind: str, header: bool = True,
                    typed: bool = True) -> DataFrame:
    """Read a CSV export of ``kind`` in ('transactions','contracts','blocks').

    Rows are text first; ``typed=True`` converts numbers with the integer
    rule of :mod:`chainscope.functions.columns`, so malformed fields become
    NULL and are removed by the cleaning operators, never by a failing job.
    Blank lines are skipped; quoted fields may hold commas.
    """
    schema = _TEXT_SCHEMAS[kind]
    df = (spark.read.schema(schema)
          .option("header", header)
          .option("mode", "PERMISSIVE")
          .option("multiLine", False)
          .csv(path))
    return _TYPERS[kind](df) if typed else df


def read_ledger_text_lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Plain comma split of each text line (no quoting), by column name; the
    fields a short line lacks are null, and cleaning then drops the row."""
    names = _TEXT_SCHEMAS[kind].fieldNames()
    parts = F.split(F.col("value"), ",")
    lines = spark.read.text(path).filter(F.length(F.trim(F.col("value"))) > 0)
    return lines.select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
