"""Row cleaning of text exports (keep rows whose fields parse)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainscope.functions.columns import int_text_or_null, is_int_text, wei_or_null


def clean_transactions(df: DataFrame, time_col: str | None = "block_timestamp",
                       value_col: str | None = "value",
                       to_col: str | None = None) -> DataFrame:
    """Keep rows whose time and value are integers (and, when ``to_col`` is
    given, whose receiver is present), then type those fields.

    Works on text columns (raw CSV) and on already typed ones (a typed
    column holds NULL where the text did not parse).
    """
    types = dict(df.dtypes)
    cond = F.lit(True)
    projected = {}
    if time_col is not None:
        c = F.col(time_col)
        if types[time_col] == "string":
            cond = cond & is_int_text(c)
            projected[time_col] = int_text_or_null(c)
        else:
            cond = cond & c.isNotNull()
    if value_col is not None:
        c = F.col(value_col)
        if types[value_col] == "string":
            cond = cond & is_int_text(c)
            projected[value_col] = wei_or_null(c)
        else:
            cond = cond & c.isNotNull()
    if to_col is not None:
        c = F.col(to_col)
        cond = cond & c.isNotNull() & (F.trim(c) != "")
    out = df.filter(cond)
    if projected:
        out = out.select(*[projected.get(n, F.col(n)).alias(n) for n in df.columns])
    # An integer that does not fit DECIMAL(38,0)/BIGINT is dropped too.
    tail = [F.col(n).isNotNull() for n in projected]
    for t in tail:
        out = out.filter(t)
    return out
