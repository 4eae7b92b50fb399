"""Keyed sums and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_by_key(df: DataFrame, key: str, value: str, out_key: str | None = None,
               out_value: str = "total", keep_null: bool = False) -> DataFrame:
    """Sum ``value`` per ``key`` (partial aggregation before the shuffle, so
    a key holding a third of the rows still sends one row per partition).
    Rows without a key are dropped, or one group with ``keep_null``."""
    rows = df if keep_null else df.filter(F.col(key).isNotNull())
    return (rows.groupBy(F.col(key).alias(out_key or key))
            .agg(F.sum(value).alias(out_value)))


def top_k(df: DataFrame, by: str, k: int, tie: str, ascending: bool = False) -> DataFrame:
    """First ``k`` rows by ``by`` (ties broken by ``tie`` ascending).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every partition
    keeps a k-row heap, so no full sort and no range shuffle.
    """
    order = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(order, F.col(tie).asc()).limit(k)
