"""Column-expression helpers (all built-in Spark functions, no UDFs)."""

from tillroll.functions.casts import (
    lenient_bigint,
    lenient_double,
    strip_leading_dollar,
)
from tillroll.functions.cleaning import (
    both_present_and_different,
    clean_price,
    clean_quantity,
    is_blank_description,
    spend,
)
from tillroll.functions.dates import (
    day_start,
    epoch_millis_to_ts,
    hour_start,
    minus_months,
    month_start,
    truncate,
    ts_literal,
    ts_to_epoch_millis,
)

__all__ = [
    "both_present_and_different",
    "clean_price",
    "clean_quantity",
    "day_start",
    "epoch_millis_to_ts",
    "hour_start",
    "is_blank_description",
    "lenient_bigint",
    "lenient_double",
    "minus_months",
    "month_start",
    "spend",
    "strip_leading_dollar",
    "truncate",
    "ts_literal",
    "ts_to_epoch_millis",
]
