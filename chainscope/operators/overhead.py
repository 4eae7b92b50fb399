"""Storage held by removable hexadecimal block columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainscope.functions.columns import hex_nibbles
from chainscope.sources.schemas import REMOVABLE_HEX_COLUMNS

# Fixed value: each hex digit after '0x' is counted as 4 bits.
BITS_PER_HEX_CHAR = 4


def hex_overhead(blocks: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: hex characters after '0x' summed over ``columns``, as bits
    (4 per character) and bytes. A value not starting with '0x' (or NULL)
    counts 0. Keyless aggregate: per-partition partial sums, one final row."""
    cols = columns or REMOVABLE_HEX_COLUMNS
    per_row = reduce(lambda a, b: a + b, [hex_nibbles(F.col(c)).cast("bigint") for c in cols])
    agg = blocks.agg(F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint").alias("hex_chars"))
    return agg.select(
        "hex_chars",
        (F.col("hex_chars") * BITS_PER_HEX_CHAR).alias("bit_count"),
        (F.col("hex_chars") * BITS_PER_HEX_CHAR / 8.0).alias("byte_count"),
    )
