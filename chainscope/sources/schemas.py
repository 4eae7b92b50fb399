"""Schemas of the ledger tables.

Raw CSV files are read with every column as text (the export writes wei
amounts with up to 27 digits, booleans as TRUE/FALSE and empty strings for
nulls); ``typed_*`` turn them into the logical types used by the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chainscope.functions.columns import int_text_or_null, wei_or_null, strict_int

# Fixed column orders of the public ledger export (values that must match).
TRANSACTION_COLUMNS = [
    "hash", "nonce", "block_hash", "block_number", "transaction_index",
    "from_address", "to_address", "value", "gas", "gas_price", "input",
    "block_timestamp", "max_fee_per_gas", "max_priority_fee_per_gas",
    "transaction_type",
]
CONTRACT_COLUMNS = [
    "address", "bytecode", "function_sighashes", "is_erc20", "is_erc721",
    "block_number",
]
BLOCK_COLUMNS = [
    "number", "hash", "parent_hash", "nonce", "sha3_uncles", "logs_bloom",
    "transactions_root", "state_root", "receipts_root", "miner", "difficulty",
    "total_difficulty", "size", "extra_data", "gas_limit", "gas_used",
    "timestamp", "transaction_count", "base_fee_per_gas",
]
# Hex columns the overhead study treats as removable (default set).
REMOVABLE_HEX_COLUMNS = [
    "sha3_uncles", "logs_bloom", "transactions_root", "state_root",
    "receipts_root", "extra_data",
]


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


TRANSACTIONS_TEXT = text_schema(TRANSACTION_COLUMNS)
CONTRACTS_TEXT = text_schema(CONTRACT_COLUMNS)
BLOCKS_TEXT = text_schema(BLOCK_COLUMNS)

_TX_BIGINT = ["nonce", "block_number", "gas", "block_timestamp"]
_TX_INT = ["transaction_index", "transaction_type"]
_TX_WEI = ["value", "gas_price", "max_fee_per_gas", "max_priority_fee_per_gas"]


def _empty_to_null(c):
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


def typed_transactions(df: DataFrame) -> DataFrame:
    """Text transactions -> typed; unparsable numbers become NULL."""
    cols = []
    for name in df.columns:
        c = F.col(name)
        if name in _TX_WEI:
            cols.append(wei_or_null(c).alias(name))
        elif name in _TX_BIGINT:
            cols.append(int_text_or_null(c).alias(name))
        elif name in _TX_INT:
            cols.append(int_text_or_null(c).try_cast("int").alias(name))
        elif name in ("to_address", "from_address"):
            cols.append(_empty_to_null(c).alias(name))
        else:
            cols.append(c)
    return df.select(*cols)


def typed_contracts(df: DataFrame) -> DataFrame:
    def flag(c):
        u = F.upper(F.trim(c))
        return F.when(u == "TRUE", True).when(u == "FALSE", False)
    return df.select(
        F.col("address"), F.col("bytecode"), F.col("function_sighashes"),
        flag(F.col("is_erc20")).alias("is_erc20"),
        flag(F.col("is_erc721")).alias("is_erc721"),
        int_text_or_null(F.col("block_number")).alias("block_number"),
    )


def typed_blocks(df: DataFrame) -> DataFrame:
    """Typed columns; a size that is no whole number fails the job, other bad
    numbers become NULL."""
    bigints = {"number", "gas_limit", "gas_used", "timestamp", "transaction_count"}
    weis = {"difficulty", "total_difficulty", "base_fee_per_gas"}
    cols = []
    for name in df.columns:
        c = F.col(name)
        if name in bigints:
            cols.append(int_text_or_null(c).alias(name))
        elif name == "size":
            cols.append(strict_int(c, "bigint").alias(name))
        elif name in weis:
            cols.append(wei_or_null(c).alias(name))
        else:
            cols.append(c)
    return df.select(*cols)
