"""Value received per address and its join with the contracts table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainscope.operators.cleaning import clean_transactions
from chainscope.operators.ranking import sum_by_key, top_k


def value_received(tx: DataFrame, to_col: str = "to_address", value_col: str = "value") -> DataFrame:
    """Total value per receiving address (rows with a value and a receiver)."""
    valid = clean_transactions(tx.select(to_col, value_col), time_col=None,
                               value_col=value_col, to_col=to_col)
    return sum_by_key(valid, to_col, value_col, out_key="address", out_value="total_value")


def contract_value_join(totals: DataFrame, contracts: DataFrame) -> DataFrame:
    """Inner join of the per-address totals with the contracts.

    The transactions are aggregated *before* the join, so the join sees one
    row per address instead of every transfer; Catalyst/AQE choose broadcast
    or sort-merge from the measured sizes.
    """
    return totals.join(contracts.select("address", "bytecode"), "address", "inner")


def top_contracts(totals: DataFrame, contracts: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` contracts by value received.

    A left-semi join on the pruned address column: the bytecode never enters
    the shuffle and a contract listed twice is counted once.
    """
    contract_addresses = contracts.select("address").filter(F.col("address").isNotNull())
    receiving = totals.join(contract_addresses, "address", "left_semi")
    return top_k(receiving, "total_value", k, tie="address")
