"""Column expressions shared by the operators.

Everything here is a built-in Spark expression, so it stays inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, NumericType, StringType, TimestampType

# Wei amounts exceed BIGINT (1e21 already in the first blocks) and their
# sums exceed 2^69, so every amount is an exact 38-digit decimal.
WEI = DecimalType(38, 0)

# What counts as an integer in the text export: optional blanks and sign,
# decimal digits only. '1.5' or '1e3' are rejected (a plain decimal cast
# would round or expand them).
INT_TEXT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"

SECONDS_PER_DAY = 86400

# Fixed value: the month label of the reports, e.g. '08-2015'.
MONTH_LABEL_FORMAT = "MM-yyyy"


def is_int_text(c: Column) -> Column:
    """True when ``c`` holds a whole number as text; NULL counts as false."""
    return F.coalesce(c.rlike(INT_TEXT_PATTERN), F.lit(False))


def wei_or_null(c: Column) -> Column:
    """Text -> DECIMAL(38,0); NULL when not an integer or out of range."""
    return F.when(is_int_text(c), F.trim(c).try_cast(WEI))


def int_text_or_null(c: Column) -> Column:
    """Text -> BIGINT; NULL when not an integer or out of range."""
    return F.when(is_int_text(c), F.trim(c).try_cast("bigint"))


def strict_int(c: Column, dtype: str = WEI) -> Column:
    """Text -> whole number; text that is none fails the job, as does a number
    out of range (ANSI). NULL stays NULL."""
    bad = F.raise_error(F.concat(F.lit("not a whole number: "), c)).cast(dtype)
    return F.when(c.isNull() | is_int_text(c), F.trim(c).cast(dtype)).otherwise(bad)


def epoch_to_date(c: Column) -> Column:
    """Unix seconds -> UTC calendar date, independent of the session zone."""
    return F.date_from_unix_date(F.floor(c / F.lit(SECONDS_PER_DAY)).cast("int"))


def month_start(c: Column, dtype: DataType) -> Column:
    """First day of the UTC month of a time column.

    ``dtype`` is the column's type: integral values are unix seconds (the
    ledger export), text is unix seconds as text, a timestamp is an instant
    and its UTC date counts in any session zone, dates and zoneless
    timestamps are used as they are.
    """
    if isinstance(dtype, StringType):
        day = epoch_to_date(int_text_or_null(c))
    elif isinstance(dtype, NumericType):
        day = epoch_to_date(c)
    elif isinstance(dtype, TimestampType):
        day = epoch_to_date(F.unix_seconds(c))
    else:
        day = F.to_date(c)
    return F.trunc(day, "MM")


def month_of_label(label: Column) -> Column:
    """First day of the month of an 'MM-yyyy' label; NULL for other text."""
    return F.try_to_date(F.concat(F.lit("01-"), label), "dd-MM-yyyy")


def month_label(month_first_day: Column) -> Column:
    """'MM-yyyy' label of a month (the report format of the ledger study)."""
    return F.date_format(month_first_day, MONTH_LABEL_FORMAT)


def not_same_address(a: Column, b: Column) -> Column:
    """Null-safe inequality: a transfer to NULL (contract creation) is not a self-trade."""
    return ~a.eqNullSafe(b)


def hex_nibbles(c: Column) -> Column:
    """Hex digits after a leading '0x'; 0 for NULL or non-hex text."""
    return F.when(F.coalesce(c.startswith("0x"), F.lit(False)), F.length(c) - 2).otherwise(0)
