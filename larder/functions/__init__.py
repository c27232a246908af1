"""Column-expression builders (``Column -> Column``), all made of built-in Spark functions."""

from larder.functions.text import clean_text, display_name, strip_accents
from larder.functions.numeric import clean_bigint, safe_ratio, strict_ratio
from larder.functions.timecols import (
    calendar_columns,
    lenient_timestamp,
    month_key,
    parse_timestamp,
    time_slot,
)

__all__ = [
    "clean_text", "display_name", "strip_accents", "clean_bigint", "safe_ratio", "strict_ratio",
    "calendar_columns", "lenient_timestamp", "month_key", "parse_timestamp", "time_slot",
]
