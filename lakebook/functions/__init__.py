"""Column expressions. All are built-in Spark functions: no UDF anywhere."""

from .casts import to_date, to_decimal, to_double, to_int, to_number
from .classes import label_class, threshold_class
from .dates import iso_date, lookback_flag, month_key, parse_day_first, version_key
from .ids import natural_key_hash, natural_key_md5
from .text import decimal_comma, tail

__all__ = [
    "decimal_comma", "iso_date", "label_class", "lookback_flag", "month_key",
    "natural_key_hash", "natural_key_md5", "parse_day_first", "tail",
    "threshold_class", "to_date", "to_decimal", "to_double", "to_int", "to_number", "version_key",
]
