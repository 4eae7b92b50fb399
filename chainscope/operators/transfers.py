"""Transfer-level wash-trading signals: self-trades, net positions and
net-neutral accounts.

Input: a transfers DataFrame with ``hash, from_address, to_address, value``
(DECIMAL(38,0)) and a time column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainscope.functions.columns import WEI, not_same_address

# The net-neutral rule of the study: |net| strictly below 15 % of the mean
# transfer value (fixed value).
NET_NEUTRAL_TOLERANCE = 0.15


def self_trades(tx: DataFrame, time_col: str = "block_timestamp") -> DataFrame:
    """Transfers whose sender is also the receiver (null-safe: exactly the
    rows :func:`without_self_trades` removes)."""
    return (tx.filter(~not_same_address(F.col("from_address"), F.col("to_address")))
            .select("hash", F.col("from_address").alias("address"), "value", F.col(time_col).alias("ts")))


def self_trade_summary(tx: DataFrame, time_col: str = "block_timestamp") -> DataFrame:
    """Per self-trading address: count, total value, first and last time.

    Aggregates only (no list of hashes), so a hot address costs one partial
    row per partition.
    """
    return (self_trades(tx, time_col)
            .groupBy("address")
            .agg(F.count(F.lit(1)).alias("n_self_trades"),
                 F.sum("value").cast(WEI).alias("self_value"),
                 F.min("ts").alias("first_ts"),
                 F.max("ts").alias("last_ts")))


def without_self_trades(tx: DataFrame) -> DataFrame:
    """Transfers that are not self-trades: a row predicate, equal to an
    anti-join on the self-trade hashes but without any join."""
    return tx.filter(not_same_address(F.col("from_address"), F.col("to_address")))


def transfer_stats(transfers: DataFrame) -> DataFrame:
    """One row: number of transfers, exact total and mean value (one job)."""
    return transfers.agg(
        F.count(F.lit(1)).alias("n_transfers"),
        F.sum("value").cast(WEI).alias("total_value"),
    ).select("n_transfers", "total_value",
             (F.col("total_value").cast("double") / F.col("n_transfers")).alias("avg_value"))


def net_positions(transfers: DataFrame, drop_null_account: bool = False) -> DataFrame:
    """Net value per account: received minus sent.

    Each transfer yields two signed legs from one scan (explode of a
    two-element array, no union); the sum is partially aggregated before the
    shuffle. A NULL receiver (contract creation) is kept as its own NULL
    account unless ``drop_null_account``.
    """
    legs = transfers.select(F.explode(F.array(
        F.struct(F.col("from_address").alias("address"), (-F.col("value")).cast(WEI).alias("amount")),
        F.struct(F.col("to_address").alias("address"), F.col("value").cast(WEI).alias("amount")),
    )).alias("leg")).select("leg.address", "leg.amount")
    if drop_null_account:
        legs = legs.filter(F.col("address").isNotNull())
    return legs.groupBy("address").agg(F.sum("amount").cast(WEI).alias("net_value"))


def net_neutral(net: DataFrame, stats: DataFrame, tolerance: float = NET_NEUTRAL_TOLERANCE) -> DataFrame:
    """Accounts with |net| < tolerance * mean transfer value.

    The mean is a one-row aggregate used as a scalar subquery: no join and
    no round trip through the driver.
    """
    mean = stats.select("avg_value").scalar()
    return net.filter(F.abs(F.col("net_value")) < F.lit(tolerance) * mean)


def net_neutral_count(net: DataFrame, stats: DataFrame,
                      tolerance: float = NET_NEUTRAL_TOLERANCE) -> DataFrame:
    """One row: number of net-neutral accounts and number of transfers."""
    candidates = net_neutral(net, stats, tolerance).agg(F.count(F.lit(1)).alias("n_candidates"))
    return candidates.select("n_candidates", stats.select("n_transfers").scalar().alias("n_transfers"))
