"""Monthly transaction statistics (UTC calendar months)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainscope.functions.columns import WEI, month_label, month_start


def _with_month(df: DataFrame, time_col: str) -> DataFrame:
    dtype = df.schema[time_col].dataType
    return df.withColumn("month_start", month_start(F.col(time_col), dtype))


def monthly_count(df: DataFrame, time_col: str = "block_timestamp") -> DataFrame:
    """Number of transactions per month, chronological."""
    out = (_with_month(df, time_col)
           .filter(F.col("month_start").isNotNull())
           .groupBy("month_start")
           .agg(F.count(F.lit(1)).alias("n_transactions")))
    return (out.select(month_label(F.col("month_start")).alias("month"), "month_start", "n_transactions")
            .orderBy("month_start"))


def monthly_count_sum(df: DataFrame, time_col: str = "block_timestamp",
                      value_col: str = "value") -> DataFrame:
    """Count and exact total value per month (one aggregation, one shuffle)."""
    out = (_with_month(df, time_col)
           .filter(F.col("month_start").isNotNull() & F.col(value_col).isNotNull())
           .groupBy("month_start")
           .agg(F.count(F.lit(1)).alias("n_transactions"),
                F.sum(F.col(value_col).cast(WEI)).cast(WEI).alias("total_value")))
    return (out.select(month_label(F.col("month_start")).alias("month"), "month_start",
                       "n_transactions", "total_value")
            .orderBy("month_start"))


def monthly_average(df: DataFrame, time_col: str = "block_timestamp",
                    value_col: str = "value") -> DataFrame:
    """Average value per month: exact sum, then one float division
    (``avg`` on DECIMAL would round to 4 decimals first)."""
    sums = monthly_count_sum(df, time_col, value_col)
    return sums.select(
        "month", "month_start",
        (F.col("total_value").cast("double") / F.col("n_transactions")).alias("avg_value"),
    ).orderBy("month_start")
