"""Column functions; all but the alias similarity stay in the JVM."""

from .numbers import coerce_number, fits_decimal, to_decimal
from .similarity import best_match, closest_name, feasible_lengths, fuzzy_alias_udf
from .text import clean_symbol, coin_slug, first_filled, strip_spaces, truncate_error
from .times import duration_seconds, has_offset_time, parse_timestamp, unix_seconds

__all__ = [
    "best_match",
    "clean_symbol",
    "closest_name",
    "coerce_number",
    "coin_slug",
    "duration_seconds",
    "feasible_lengths",
    "first_filled",
    "fits_decimal",
    "fuzzy_alias_udf",
    "has_offset_time",
    "parse_timestamp",
    "strip_spaces",
    "to_decimal",
    "truncate_error",
    "unix_seconds",
]
