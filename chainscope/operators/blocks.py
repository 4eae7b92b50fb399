"""Block size mined per miner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainscope.functions.columns import strict_int
from chainscope.operators.ranking import sum_by_key, top_k


def miner_block_size(blocks: DataFrame, miner_col: str = "miner", size_col: str = "size") -> DataFrame:
    """Total block size per miner (miner, total_size); blocks without a miner
    are a group of their own. A size given as text that is no whole number
    fails the job; blocks without a size are left out."""
    text = dict(blocks.dtypes)[size_col] == "string"
    size = strict_int(F.col(size_col), "bigint") if text else F.col(size_col).cast("bigint")
    sized = blocks.select(miner_col, size.alias(size_col)).filter(F.col(size_col).isNotNull())
    return sum_by_key(sized, miner_col, size_col, out_key="miner", out_value="total_size",
                      keep_null=True)


def top_miners(per_miner: DataFrame, k: int = 10, ascending: bool = False) -> DataFrame:
    """Largest (or, ``ascending=True``, smallest) ``k`` miners by size."""
    return top_k(per_miner, "total_size", k, tie="miner", ascending=ascending)
