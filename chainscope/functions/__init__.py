from chainscope.functions.columns import (  # noqa: F401
    epoch_to_date, hex_nibbles, int_text_or_null, is_int_text, month_label,
    month_start, not_same_address, strict_int, wei_or_null,
)
